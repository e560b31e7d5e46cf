"""Projection and S2 formulas as SQL text, for the oracle only."""

from __future__ import annotations


from cellweave.functions import crs
from cellweave.functions.s2 import IJ_TO_POS, POS_TO_IJ, POS_TO_ORIENTATION


def _d(v: float) -> str:
    return f"({v!r}::double)"


def _rho(lat: str) -> str:
    s = f"sin(radians({lat}))"
    q = f"({_d(1 - crs.E2)} * ({s}/(1-{_d(crs.E2)}*{s}*{s}) - ln((1-{_d(crs.E1)}*{s})/(1+{_d(crs.E1)}*{s}))/{_d(2 * crs.E1)}))"
    return f"({_d(crs.WGS84_A)} * sqrt({_d(crs.ALBERS_C)} - {_d(crs.ALBERS_N)}*{q}) / {_d(crs.ALBERS_N)})"


def albers_x(lon: str, lat: str) -> str:
    return f"({_rho(lat)} * sin({_d(crs.ALBERS_N)} * radians({lon} - 25)))"


def albers_y(lon: str, lat: str) -> str:
    return f"({_d(crs.ALBERS_RHO0)} - {_rho(lat)} * cos({_d(crs.ALBERS_N)} * radians({lon} - 25)))"


def _xi_eta(lon: str, lat: str, zone: int) -> tuple[str, str]:
    s, lam = f"sin(radians({lat}))", f"radians({lon} - {zone * 6 - 183})"
    psi = f"(atanh({s}) - {_d(crs.E1)}*atanh({_d(crs.E1)}*{s}))"
    t = f"((exp({psi}) - exp(-{psi}))/2)"
    return f"atan2({t}, cos({lam}))", f"atanh(sin({lam})/sqrt(1+{t}*{t}))"


def _series(main: str, other: str, f: str, g: str) -> str:
    hyper = {"sinh": "((exp({0})-exp(-({0})))/2)", "cosh": "((exp({0})+exp(-({0})))/2)"}
    terms = []
    for j, a in enumerate(crs.TM_ALPHA, start=1):
        terms.append(f"{_d(a)}*{f}({2 * j}*({main}))*" + hyper[g].format(f"{2 * j}*({other})"))
    return " + ".join(terms)


def utm_x(lon: str, lat: str, zone: int) -> str:
    xi, eta = _xi_eta(lon, lat, zone)
    return f"(500000 + {_d(crs.UTM_K0 * crs.TM_RADIUS)} * ({eta} + {_series(xi, eta, 'cos', 'sinh')}))"


def utm_y(lon: str, lat: str, zone: int) -> str:
    xi, eta = _xi_eta(lon, lat, zone)
    return f"({_d(crs.UTM_K0 * crs.TM_RADIUS)} * ({xi} + {_series(xi, eta, 'sin', 'cosh')}))"


def s2_tokens(level: int, points: str, key: str) -> str:
    """``key, token`` of points with ``lon`` and ``lat``; the curve is walked level by level."""
    uv = (
        "case face when 0 then y/x when 1 then -x/y when 2 then -x/z when 3 then z/x when 4 then z/y else -y/z end",
        "case face when 0 then z/x when 1 then z/y when 2 then -y/z when 3 then y/x when 4 then -x/y else -x/z end",
    )
    st = "case when {0} >= 0 then 0.5*sqrt(1+3*{0}) else 1-0.5*sqrt(1-3*{0}) end"
    sql = f"""select {key}, cos(radians(lat))*cos(radians(lon)) as x, cos(radians(lat))*sin(radians(lon)) as y, sin(radians(lat)) as z from ({points}) p0"""
    sql = f"""select *, case when abs(x) > abs(y) and abs(x) > abs(z) then case when x < 0 then 3 else 0 end
      when abs(y) > abs(z) then case when y < 0 then 4 else 1 end else case when z < 0 then 5 else 2 end end as face from ({sql}) p1"""
    sql = f"select *, {uv[0]} as u, {uv[1]} as v from ({sql}) p2"
    cell = "cast(greatest(0, least({n}-1, floor(({e})*{n}))) as bigint)"
    i, j = (cell.format(n=1 << level, e=st.format(w)) for w in "uv")
    sql = f"select {key}, face, {i} as i, {j} as j, face % 2 as o, 0::bigint as pos from ({sql}) p3"
    ij, turn = list(IJ_TO_POS), list(POS_TO_ORIENTATION)
    for k in range(level - 1, -1, -1):
        sql = f"select *, {ij}[cast(o*4 + ((i >> {k}) & 1)*2 + ((j >> {k}) & 1) + 1 as int)] as q from ({sql}) a{k}"
        sql = f"select {key}, face, i, j, cast(xor(cast(o as int), cast({turn}[cast(q + 1 as int)] as int)) as int) as o, pos*4 + q as pos from ({sql}) b{k}"
    number = f"(face::hugeint * {1 << 61} + pos::hugeint * {1 << (61 - 2 * level)} + {1 << (60 - 2 * level)})"
    return f"select {key}, rtrim(lpad(lower(to_hex({number}::ubigint)), 16, '0'), '0') as token from ({sql}) z"




def s2_corners(level: int, cells: str, key: str) -> str:
    """``key, seq, x, y``: four corners of cells given by ``face`` and ``pos``."""
    sql = f"select {key}, face, pos, face % 2 as o, 0::bigint as i, 0::bigint as j from ({cells}) c0"
    ij, turn = list(POS_TO_IJ), list(POS_TO_ORIENTATION)
    for k in range(level - 1, -1, -1):
        sql = f"select *, cast((pos >> {2 * k}) & 3 as int) as q from ({sql}) a{k}"
        sql = f"select *, {ij}[cast(o*4 + q + 1 as int)] as ij from ({sql}) b{k}"
        sql = f"""select {key}, face, pos, cast(xor(cast(o as int), cast({turn}[q + 1] as int)) as int) as o,
          i*2 + (ij // 2) as i, j*2 + ij % 2 as j from ({sql}) d{k}"""
    uv = "case when {0} >= 0.5 then (4*{0}*{0}-1)/3 else (1-4*(1-{0})*(1-{0}))/3 end"
    n = f"{float(1 << level)!r}"
    sql = f"""select {key}, face, seq, (i + case when seq in (1, 2) then 1 else 0 end)/{n} as s,
      (j + case when seq in (2, 3) then 1 else 0 end)/{n} as t from ({sql}) e0, range(4) r(seq)"""
    sql = f"select {key}, face, seq, {uv.format('s')} as u, {uv.format('t')} as v from ({sql}) e1"
    sql = f"""select {key}, seq, case face when 0 then 1.0 when 1 then -u when 2 then -u when 3 then -1.0 else v end as x,
      case face when 0 then u when 1 then 1.0 when 2 then -v when 3 then -v when 4 then -1.0 else u end as y,
      case face when 0 then v when 1 then v when 2 then 1.0 when 3 then -u when 4 then -u else -1.0 end as z from ({sql}) e2"""
    return f"select {key}, seq, degrees(atan2(y, x)) as x, degrees(atan2(z, sqrt(x*x + y*y))) as y from ({sql}) e3"
