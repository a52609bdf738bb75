"""Deterministic detector-response columns: efficiencies and resolutions."""

from __future__ import annotations

from .numeric import Sql, num

# fixed values: (pt in GeV, efficiency) knots; linear in between, zero up to the
# first knot and constant beyond the last
EFFICIENCY_KNOTS = {
    ("electron", "reco_id"): ((4.0, 0.0), (5.0, 0.85), (7.0, 0.90), (10.0, 0.92), (15.0, 0.95), (30.0, 0.96)),
    ("electron", "isolation"): (
        (4.0, 0.0), (5.0, 0.68), (7.0, 0.77), (10.0, 0.84), (15.0, 0.91), (20.0, 0.95), (25.0, 0.97), (30.0, 0.985),
    ),
    ("muon", "reco_id"): ((4.0, 0.0), (5.0, 0.96), (6.0, 0.98), (8.0, 0.985), (10.0, 0.99)),
    ("muon", "isolation"): (
        (4.0, 0.0), (5.0, 0.72), (6.0, 0.80), (8.0, 0.88), (10.0, 0.92), (15.0, 0.96), (20.0, 0.985), (30.0, 0.995),
    ),
}
# fixed values: (upper |eta| edge, factor); edges are inclusive except the last
ETA_FACTORS = {
    ("electron", "reco_id"): ((0.8, 1.02), (1.37, 1.00), (1.52, 0.94), (2.0, 0.99), (2.5, 0.96)),
    ("muon", "reco_id"): ((0.1, 0.995), (1.0, 1.000), (1.3, 0.995), (2.0, 1.000), (2.5, 0.995)),
}
# fixed values: upper |eta| edge, stochastic, noise, pile-up noise, two constant terms
ELECTRON_RESOLUTION = (
    (0.8, 0.09, 0.30, 0.55, 0.004, 0.007),
    (1.37, 0.12, 0.84, 0.55, 0.004, 0.009),
    (1.52, 0.15, 1.20, 0.70, 0.010, 0.025),
    (2.0, 0.10, 0.55, 0.60, 0.004, 0.015),
    (2.5, 0.08, 0.50, 0.60, 0.004, 0.017),
)
# fixed values: upper |eta| edge, constant term, slope in pt
MUON_RESOLUTION = ((0.5, 0.01, 1.0e-4), (1.5, 0.015, 1.5e-4), (2.5, 0.025, 3.5e-4))
MAX_ABS_ETA = 2.5


def _by_eta(eta: Sql, rows: list[tuple[float, Sql]]) -> Sql:
    """Value of the |eta| region; 0 outside the acceptance."""
    cases = [
        f"when abs({eta}) {'<' if i == len(rows) - 1 else '<='} {num(edge)} then {value}"
        for i, (edge, value) in enumerate(rows)
    ]
    return f"(case {' '.join(cases)} else 0D end)"


def efficiency(flavor: str, kind: str, pt: Sql, eta: Sql) -> Sql:
    """Piecewise-linear efficiency in pt, times a factor in |eta| where one exists."""
    knots = EFFICIENCY_KNOTS[flavor, kind]
    cases = [f"when {pt} <= {num(knots[0][0])} then 0D"]
    for (p0, e0), (p1, e1) in zip(knots, knots[1:]):
        cases.append(
            f"when {pt} <= {num(p1)} then {num(e0)} + ({num(e1)} - {num(e0)}) * ({pt} - {num(p0)}) / {num(p1 - p0)}"
        )
    curve = f"(case {' '.join(cases)} when isnan({pt}) then 0D else {num(knots[-1][1])} end)"
    factors = ETA_FACTORS.get((flavor, kind), ((MAX_ABS_ETA, 1.0),))
    return f"({curve} * {_by_eta(eta, [(e, num(f)) for e, f in factors])})"


def relative_resolution(flavor: str, pt: Sql, eta: Sql, energy: Sql) -> Sql:
    """sigma(pT)/pT of a lepton; 0 outside the acceptance."""
    if flavor == "electron":
        et = f"greatest({energy} / cosh({eta}), 1D)"
        rows = [
            (
                edge,
                f"sqrt({num(s * s)} / {et} + ({num(n * n)} + {num(p * p)}) / ({et} * {et}) "
                f"+ {num(c * c)} + {num(d * d)})",
            )
            for edge, s, n, p, c, d in ELECTRON_RESOLUTION
        ]
        return _by_eta(eta, rows)
    if flavor == "muon":
        rows = [
            (edge, f"if({pt} > 0.1D, sqrt({num(a * a)} + {pt} * {pt} * {num(b * b)}), 0D)")
            for edge, a, b in MUON_RESOLUTION
        ]
        return _by_eta(eta, rows)
    raise ValueError(f"unknown flavour {flavor!r}")
