"""Goal-rate expressions: two independent Poisson rates from 1X2 probabilities.

Home and away goals are taken as independent Poisson counts.  Their difference
then has closed forms for what a Newton step needs: with ``z``, ``p`` and ``q`` the
probabilities that the difference is 0, 1 and -1 and ``h`` that it is positive,
``dh/dl = z``, ``dh/dm = -p``, ``dz/dl = q - z`` and ``dz/dm = p - z``.  The determinant
``pq - zz`` is never 0, so a fixed number of steps on the logarithms of the rates,
started from a normal approximation, reproduces any probabilities.

The steps are one higher-order SQL expression: no UDF, no join, no exchange.
"""

from __future__ import annotations

#: Newton steps; a step changes a rate by a factor of e at most.
STEPS = 14
#: The logistic curve that is nearest to the normal one has this scale.
_LOGIT = 1.702


def _difference_sql(home: str, away: str) -> str:
    """``h, z, p, q`` of the rates ``home`` and ``away`` (SQL names): a fold over the
    goals either side may score, as many as matter at those rates."""
    most = f"CAST(ceil(greatest({home}, {away}) + 9D * sqrt(greatest({home}, {away})) + 14D) AS INT)"
    a, b = f"(t.a * {home} / k)", f"(t.b * {away} / k)"
    return (f"aggregate(sequence(1, {most}), named_struct('a', exp(-{home}), 'b', exp(-{away}), 'c', exp(-{away}), "
            f"'h', 0D, 'z', exp(-{home} - {away}), 'p', 0D, 'q', 0D), "
            f"(t, k) -> named_struct('a', {a}, 'b', {b}, 'c', t.c + {b}, 'h', t.h + {a} * t.c, "
            f"'z', t.z + {a} * {b}, 'p', t.p + {a} * t.b, 'q', t.q + t.a * {b}))")


def goal_rates_sql(p_home: str, p_draw: str, p_away: str, steps: int = STEPS) -> str:
    """A struct ``home, away`` of the goal rates whose outcome probabilities are the
    given ones (which sum to 1); null where one is null or not inside 0 to 1."""
    z_home, z_away = (f"(ln({p} / (1D - {p})) / {_LOGIT}D)" for p in (p_home, p_away))
    root = f"greatest(-1D / ({z_home} + {z_away}), 0.3D)"
    total, gap = f"({root} * {root})", f"(0.5D + {z_home} * {root})"
    start = (f"named_struct('l', greatest(({total} + {gap}) / 2D, 0.05D), 'm', greatest(({total} - {gap}) / 2D, 0.05D))")
    det = "(s.l * s.m * (g.p * g.q - g.z * g.z))"
    off_home, off_draw = f"(g.h - {p_home})", f"(g.z - {p_draw})"
    du = f"((g.p - g.z) * s.m * {off_home} + g.p * s.m * {off_draw}) / {det}"
    dv = f"((g.z - g.q) * s.l * {off_home} + g.z * s.l * {off_draw}) / {det}"
    step = (f"transform(array({_difference_sql('s.l', 's.m')}), g -> named_struct("
            f"'l', s.l * exp(-least(greatest({du}, -1D), 1D)), 'm', s.m * exp(-least(greatest({dv}, -1D), 1D))))[0]")
    fitted = f"aggregate(sequence(1, {int(steps)}), {start}, (s, i) -> {step}, s -> named_struct('home', s.l, 'away', s.m))"
    inside = " AND ".join(f"{p} > 0D AND {p} < 1D" for p in (p_home, p_draw, p_away))
    return f"CASE WHEN {inside} THEN {fitted} END"


def outcome_probabilities_sql(home: str, away: str) -> str:
    """A struct ``home, draw, away`` of the outcome probabilities of two goal rates."""
    return (f"transform(array({_difference_sql(home, away)}), "
            f"g -> named_struct('home', g.h, 'draw', g.z, 'away', 1D - g.h - g.z))[0]")


def over_sql(home: str, away: str, line: float = 2.5) -> str:
    """The probability of more goals than ``line`` (a half line) at two goal rates."""
    if line < 0 or line != int(line) + 0.5:
        raise ValueError("an over/under line is a whole number and a half")
    total, term = f"({home} + {away})", "1D"
    terms = [term]
    for k in range(1, int(line) + 1):
        term = f"{term} * {total} / {float(k)}D"
        terms.append(term)
    return f"(1D - exp(-{total}) * ({' + '.join(terms)}))"
