"""SGP4/SDP4 orbit propagation as Spark SQL expressions.

The published model (Spacetrack Report #3 with the corrections of Vallado et al.,
AIAA 2006-6753), near-earth and deep-space, written as stages of `name = expression`
that Spark evaluates inside generated code: no Python touches a row. What depends on the
orbit alone comes first and is computed once for all instants. Lines that only
matter for deep-space orbits (period of 225 minutes or more) are evaluated for those
rows only.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TWO_PI = 2 * math.pi


@dataclass(frozen=True)
class Gravity:
    """Earth constants; the square root of mu is in earth radii to 1.5 per minute."""

    mu: float
    radius: float
    j2: float
    j3: float
    j4: float

    @property
    def xke(self) -> float:
        return 60.0 / math.sqrt(self.radius**3 / self.mu)


# Published earth models.
WGS72 = Gravity(398600.8, 6378.135, 0.001082616, -0.00000253881, -0.00000165597)
WGS84 = Gravity(398600.5, 6378.137, 0.00108262998905, -0.00000253215306, -0.00000161098761)

_FLOAT = re.compile(r"(?<![\w.])(\d+\.\d*(?:e[+-]?\d+)?|\d+e[+-]?\d+)(?![\w.])", re.I)


def _stage(df: DataFrame, text: str, only_if: str | None = None) -> DataFrame:
    """Add the `name = expression` lines as columns, each free to use those above it.

    Spark orders them, writes single-use values into the line that uses them and drops what nothing reads.
    Decimal numbers become double literals. A line with a lambda needs a stage of its own.
    """
    columns = []
    for line in filter(str.strip, text.splitlines()):
        name, expression = (part.strip() for part in line.split("=", 1))
        expression = _FLOAT.sub(r"\1D", expression)
        columns.append(f"{f'CASE WHEN {only_if} THEN {expression} END' if only_if else expression} AS {name}")
    return df.selectExpr("*", *columns)


def _initial(g: Gravity) -> str:
    j3oj2 = g.j3 / g.j2
    return f"""
cosi = cos(incl)
sini = sin(incl)
cosi2 = cosi * cosi
eccsq = ecc * ecc
omeosq = 1.0 - eccsq
rteosq = sqrt(omeosq)
con42 = 1.0 - 5.0 * cosi2
con41 = 3.0 * cosi2 - 1.0
x1mth2 = 1.0 - cosi2
x7thm1 = 7.0 * cosi2 - 1.0
ak = pow({g.xke!r} / kozai, 2.0 / 3.0)
shape = 0.75 * {g.j2!r} * con41 / nullif(rteosq * omeosq, 0.0)
del0 = shape / (ak * ak)
adel = ak * (1.0 - del0 * del0 - del0 * (1.0 / 3.0 + 134.0 * del0 * del0 / 81.0))
no = kozai / (1.0 + shape / (adel * adel))
ao = pow({g.xke!r} / no, 2.0 / 3.0)
po = ao * omeosq
pinvsq = 1.0 / (po * po)
rp = ao * (1.0 - ecc)
deep = {TWO_PI!r} / no >= 225.0
simple = deep OR rp < 220.0 / {g.radius!r} + 1.0
perigee_km = (rp - 1.0) * {g.radius!r}
s_km = CASE WHEN perigee_km < 98.0 THEN 20.0 WHEN perigee_km < 156.0 THEN perigee_km - 78.0 ELSE 78.0 END
sfour = s_km / {g.radius!r} + 1.0
qzms24 = pow((120.0 - s_km) / {g.radius!r}, 4)
tsi = 1.0 / nullif(ao - sfour, 0.0)
eta = ao * ecc * tsi
etasq = eta * eta
eeta = ecc * eta
psisq = abs(1.0 - etasq)
coef = qzms24 * pow(tsi, 4)
coef1 = coef / nullif(pow(psisq, 3.5), 0.0)
cc2 = coef1 * no * (ao * (1.0 + 1.5 * etasq + eeta * (4.0 + etasq)) + 0.375 * {g.j2!r} * tsi / psisq * con41 * (8.0 + 3.0 * etasq * (8.0 + etasq)))
cc1 = bstar * cc2
cc3 = CASE WHEN ecc > 1.0e-4 THEN -2.0 * coef * tsi * {j3oj2!r} * no * sini / ecc ELSE 0.0 END
cc4 = 2.0 * no * coef1 * ao * omeosq * (eta * (2.0 + 0.5 * etasq) + ecc * (0.5 + 2.0 * etasq) - {g.j2!r} * tsi / (ao * psisq) * (-3.0 * con41 * (1.0 - 2.0 * eeta + etasq * (1.5 - 0.5 * eeta)) + 0.75 * x1mth2 * (2.0 * etasq - eeta * (1.0 + etasq)) * cos(2.0 * argp)))
cc5 = 2.0 * coef1 * ao * omeosq * (1.0 + 2.75 * (etasq + eeta) + eeta * etasq)
cosi4 = cosi2 * cosi2
temp1 = 1.5 * {g.j2!r} * pinvsq * no
temp2 = 0.5 * temp1 * {g.j2!r} * pinvsq
temp3 = -0.46875 * {g.j4!r} * pinvsq * pinvsq * no
mdot = no + 0.5 * temp1 * rteosq * con41 + 0.0625 * temp2 * rteosq * (13.0 - 78.0 * cosi2 + 137.0 * cosi4)
argpdot = -0.5 * temp1 * con42 + 0.0625 * temp2 * (7.0 - 114.0 * cosi2 + 395.0 * cosi4) + temp3 * (3.0 - 36.0 * cosi2 + 49.0 * cosi4)
xhdot1 = -temp1 * cosi
nodedot = xhdot1 + (0.5 * temp2 * (4.0 - 19.0 * cosi2) + 2.0 * temp3 * (3.0 - 7.0 * cosi2)) * cosi
omgcof = bstar * cc3 * cos(argp)
xmcof = CASE WHEN ecc > 1.0e-4 THEN -2.0 / 3.0 * coef * bstar / nullif(eeta, 0.0) ELSE 0.0 END
nodecf = 3.5 * omeosq * xhdot1 * cc1
delmo = pow(1.0 + eta * cos(mean), 3)
cc1sq = cc1 * cc1
d2 = 4.0 * ao * tsi * cc1sq
dtemp = d2 * tsi * cc1 / 3.0
d3 = (17.0 * ao + sfour) * dtemp
d4 = 0.5 * dtemp * ao * tsi * (221.0 * ao + 31.0 * sfour) * cc1
"""


_SECULAR = """
xmdf = mean + mdot * t
argpdf = argp + argpdot * t
t2 = t * t
node_m = node + nodedot * t + nodecf * t2
drag_shift = CASE WHEN simple THEN 0.0 ELSE omgcof * t + xmcof * (pow(1.0 + eta * cos(xmdf), 3) - delmo) END
mean_1 = xmdf + drag_shift
argp_1 = argpdf - drag_shift
tempa = 1.0 - cc1 * t - CASE WHEN simple THEN 0.0 ELSE d2 * t2 + d3 * t2 * t + d4 * t2 * t2 END
tempe = bstar * cc4 * t + CASE WHEN simple THEN 0.0 ELSE bstar * cc5 * (sin(mean_1) - sin(mean)) END
t3cof = d2 + 2.0 * cc1sq
t4cof = 0.25 * (3.0 * d3 + cc1 * (12.0 * d2 + 10.0 * cc1sq))
t5cof = 0.2 * (3.0 * d4 + 12.0 * cc1 * d3 + 6.0 * d2 * d2 + 15.0 * cc1sq * (2.0 * d2 + cc1sq))
templ = 1.5 * cc1 * t2 + CASE WHEN simple THEN 0.0 ELSE t3cof * t2 * t + t2 * t2 * (t4cof + t * t5cof) END
"""

# Fixed values of the deep-space model: mean motions and eccentricities of sun and moon.
ZNS, ZES, ZNL, ZEL = 1.19459e-5, 0.01675, 1.5835218e-4, 0.05490
EARTH_RATE = 4.37526908801129966e-3

_THIRD_BODIES = f"""
d1950 = epoch_day + 18263.0
tut1 = (epoch_day - 0.5) / 36525.0
gsto_raw = (((-6.2e-6 * tut1 + 0.093104) * tut1 + (876600.0 * 3600.0 + 8640184.812866)) * tut1 + 67310.54841) * {math.pi / 180.0 / 240.0!r} % {TWO_PI!r}
gsto = CASE WHEN gsto_raw < 0.0 THEN gsto_raw + {TWO_PI!r} ELSE gsto_raw END
day = d1950 + 18261.5
snod = sin(node)
cnod = cos(node)
sarg = sin(argp)
carg = cos(argp)
lnode = (4.5236020 - 9.2422029e-4 * day) % {TWO_PI!r}
stem = sin(lnode)
ctem = cos(lnode)
l_cosi = 0.91375164 - 0.03568096 * ctem
l_sini = sqrt(1.0 - l_cosi * l_cosi)
l_sinh0 = 0.089683511 * stem / l_sini
l_cosh0 = sqrt(1.0 - l_sinh0 * l_sinh0)
gam = 5.8351514 + 0.0019443680 * day
zx = gam + atan2(0.39785416 * stem / l_sini, l_cosh0 * ctem + 0.91744867 * l_sinh0 * stem) - lnode
l_cosg = cos(zx)
l_sing = sin(zx)
l_cosh = l_cosh0 * cnod + l_sinh0 * snod
l_sinh = snod * l_cosh0 - cnod * l_sinh0
s_cosg = 0.1945905
s_sing = -0.98088458
s_cosi = 0.91744867
s_sini = 0.39785416
s_cosh = cnod
s_sinh = snod
l_m0 = (4.7199672 + 0.22997150 * day - gam) % {TWO_PI!r}
s_m0 = (6.2565837 + 0.017201977 * day) % {TWO_PI!r}
"""


def _third_body(p: str, strength: float, ecc: float) -> str:
    """Secular and periodic coefficients of the sun (`s`) or the moon (`l`)."""
    return f"""
{p}a1 = {p}_cosg * {p}_cosh + {p}_sing * {p}_cosi * {p}_sinh
{p}a3 = -{p}_sing * {p}_cosh + {p}_cosg * {p}_cosi * {p}_sinh
{p}a7 = -{p}_cosg * {p}_sinh + {p}_sing * {p}_cosi * {p}_cosh
{p}a8 = {p}_sing * {p}_sini
{p}a9 = {p}_sing * {p}_sinh + {p}_cosg * {p}_cosi * {p}_cosh
{p}a10 = {p}_cosg * {p}_sini
{p}a2 = cosi * {p}a7 + sini * {p}a8
{p}a4 = cosi * {p}a9 + sini * {p}a10
{p}a5 = -sini * {p}a7 + cosi * {p}a8
{p}a6 = -sini * {p}a9 + cosi * {p}a10
{p}x1 = {p}a1 * carg + {p}a2 * sarg
{p}x2 = {p}a3 * carg + {p}a4 * sarg
{p}x3 = -{p}a1 * sarg + {p}a2 * carg
{p}x4 = -{p}a3 * sarg + {p}a4 * carg
{p}x5 = {p}a5 * sarg
{p}x6 = {p}a6 * sarg
{p}x7 = {p}a5 * carg
{p}x8 = {p}a6 * carg
{p}z31 = 12.0 * {p}x1 * {p}x1 - 3.0 * {p}x3 * {p}x3
{p}z32 = 24.0 * {p}x1 * {p}x2 - 6.0 * {p}x3 * {p}x4
{p}z33 = 12.0 * {p}x2 * {p}x2 - 3.0 * {p}x4 * {p}x4
{p}z1 = 6.0 * ({p}a1 * {p}a1 + {p}a2 * {p}a2) + (1.0 + eccsq) * {p}z31
{p}z2 = 12.0 * ({p}a1 * {p}a3 + {p}a2 * {p}a4) + (1.0 + eccsq) * {p}z32
{p}z3 = 6.0 * ({p}a3 * {p}a3 + {p}a4 * {p}a4) + (1.0 + eccsq) * {p}z33
{p}z11 = -6.0 * {p}a1 * {p}a5 + eccsq * (-24.0 * {p}x1 * {p}x7 - 6.0 * {p}x3 * {p}x5)
{p}z12 = -6.0 * ({p}a1 * {p}a6 + {p}a3 * {p}a5) + eccsq * (-24.0 * ({p}x2 * {p}x7 + {p}x1 * {p}x8) - 6.0 * ({p}x3 * {p}x6 + {p}x4 * {p}x5))
{p}z13 = -6.0 * {p}a3 * {p}a6 + eccsq * (-24.0 * {p}x2 * {p}x8 - 6.0 * {p}x4 * {p}x6)
{p}z21 = 6.0 * {p}a2 * {p}a5 + eccsq * (24.0 * {p}x1 * {p}x5 - 6.0 * {p}x3 * {p}x7)
{p}z22 = 6.0 * ({p}a4 * {p}a5 + {p}a2 * {p}a6) + eccsq * (24.0 * ({p}x2 * {p}x5 + {p}x1 * {p}x6) - 6.0 * ({p}x4 * {p}x7 + {p}x3 * {p}x8))
{p}z23 = 6.0 * {p}a4 * {p}a6 + eccsq * (24.0 * {p}x2 * {p}x6 - 6.0 * {p}x4 * {p}x8)
{p}s3 = {strength!r} / no
{p}s2 = -0.5 * {p}s3 / rteosq
{p}s4 = {p}s3 * rteosq
{p}s1 = -15.0 * ecc * {p}s4
{p}e2 = 2.0 * {p}s1 * ({p}x2 * {p}x3 + {p}x1 * {p}x4)
{p}e3 = 2.0 * {p}s1 * ({p}x2 * {p}x4 - {p}x1 * {p}x3)
{p}i2 = 2.0 * {p}s2 * {p}z12
{p}i3 = 2.0 * {p}s2 * ({p}z13 - {p}z11)
{p}l2 = -2.0 * {p}s3 * {p}z2
{p}l3 = -2.0 * {p}s3 * ({p}z3 - {p}z1)
{p}l4 = -2.0 * {p}s3 * (-21.0 - 9.0 * eccsq) * {ecc!r}
{p}gh2 = 2.0 * {p}s4 * {p}z32
{p}gh3 = 2.0 * {p}s4 * ({p}z33 - {p}z31)
{p}gh4 = -18.0 * {p}s4 * {ecc!r}
{p}h2 = -2.0 * {p}s2 * {p}z22
{p}h3 = -2.0 * {p}s2 * ({p}z23 - {p}z21)
"""


def _third_body_rates(p: str, motion: float) -> str:
    flat = f"incl < 5.2359877e-2 OR incl > {math.pi!r} - 5.2359877e-2"
    return f"""
{p}_de = {p}s1 * {motion!r} * ({p}x1 * {p}x3 + {p}x2 * {p}x4)
{p}_di = {p}s2 * {motion!r} * ({p}z11 + {p}z13)
{p}_dm = -{motion!r} * {p}s3 * ({p}z1 + {p}z3 - 14.0 - 6.0 * eccsq)
{p}_dh = CASE WHEN {flat} THEN 0.0 ELSE -{motion!r} * {p}s2 * ({p}z21 + {p}z23) / nullif(sini, 0.0) END
{p}_dg = {p}s4 * {motion!r} * ({p}z31 + {p}z33 - 6.0) - cosi * {p}_dh
"""


def _third_body_periodics(p: str, motion: float, ecc: float) -> str:
    return f"""
{p}zm = {p}_m0 + {motion!r} * t
{p}zf = {p}zm + 2.0 * {ecc!r} * sin({p}zm)
{p}f2 = 0.5 * sin({p}zf) * sin({p}zf) - 0.25
{p}f3 = -0.5 * sin({p}zf) * cos({p}zf)
{p}_pe = {p}e2 * {p}f2 + {p}e3 * {p}f3
{p}_pi = {p}i2 * {p}f2 + {p}i3 * {p}f3
{p}_pl = {p}l2 * {p}f2 + {p}l3 * {p}f3 + {p}l4 * sin({p}zf)
{p}_pg = {p}gh2 * {p}f2 + {p}gh3 * {p}f3 + {p}gh4 * sin({p}zf)
{p}_ph = {p}h2 * {p}f2 + {p}h3 * {p}f3
"""


def _cubic(*coefficients: float) -> str:
    """Polynomial in the eccentricity, constant first."""
    powers = ("", " * ecc", " * eccsq", " * ecc * eccsq")
    return "(" + " + ".join(f"({c!r}){p}" for c, p in zip(coefficients, powers)) + ")"


# Fixed values of the 12-hour resonance: eccentricity polynomials below and above a limit.
_G211 = ((3.616, -13.247, 16.29), (-72.099, 331.819, -508.738, 266.724))
_G310 = ((-19.302, 117.39, -228.419, 156.591), (-346.844, 1582.851, -2415.925, 1246.113))
_G322 = ((-18.9068, 109.7927, -214.6334, 146.5816), (-342.585, 1554.908, -2366.899, 1215.972))
_G410 = ((-41.122, 242.694, -471.094, 313.953), (-1052.797, 4758.686, -7193.992, 3651.957))
_G422 = ((-146.407, 841.88, -1629.014, 1083.435), (-3581.69, 16178.11, -24462.77, 12422.52))
_G520 = ((-532.114, 3017.977, -5740.032, 3708.276), (1464.74, -4664.75, 3763.64), (-5149.66, 29936.92, -54087.36, 31324.56))
_G533 = ((-919.2277, 4988.61, -9064.77, 5542.21), (-37995.78, 161616.52, -229838.2, 109377.94))
_G521 = ((-822.71072, 4568.6173, -8491.4146, 5337.524), (-51752.104, 218913.95, -309468.16, 146349.42))
_G532 = ((-853.666, 4690.25, -8624.77, 5341.4), (-40023.88, 170470.89, -242699.48, 115605.82))


def _two_part(polynomials: tuple, limit: str) -> str:
    return f"CASE WHEN ecc {limit} THEN {_cubic(*polynomials[0])} ELSE {_cubic(*polynomials[1])} END"


def _resonance(g: Gravity) -> str:
    """Class 1: one turn per day. Class 2: two turns per day on an eccentric orbit."""
    g520 = (
        f"CASE WHEN ecc <= 0.65 THEN {_cubic(*_G520[0])} WHEN ecc > 0.715 THEN {_cubic(*_G520[2])} "
        f"ELSE {_cubic(*_G520[1])} END"
    )
    return f"""
dedt = s_de + l_de
didt = s_di + l_di
dmdt = s_dm + l_dm
domdt = s_dg + l_dg
dnodt = s_dh + l_dh
class = CASE WHEN no > 0.0034906585 AND no < 0.0052359877 THEN 1 WHEN no >= 8.26e-3 AND no <= 9.24e-3 AND ecc >= 0.5 THEN 2 ELSE 0 END
aonv = pow(no / {g.xke!r}, 2.0 / 3.0)
k2 = 3.0 * no * no * aonv * aonv
del1 = k2 * (0.9375 * sini * sini * (1.0 + 3.0 * cosi) - 0.75 * (1.0 + cosi)) * (1.0 + 2.0 * eccsq) * 2.1460748e-6 * aonv
del2 = 2.0 * k2 * 0.75 * (1.0 + cosi) * (1.0 + cosi) * (1.0 + eccsq * (-2.5 + 0.8125 * eccsq)) * 1.7891679e-6
del3 = 3.0 * k2 * 1.875 * pow(1.0 + cosi, 3) * (1.0 + eccsq * (-6.0 + 6.60937 * eccsq)) * 2.2123015e-7 * aonv
sini2 = sini * sini
f220 = 0.75 * (1.0 + 2.0 * cosi + cosi2)
f522 = 9.84375 * sini * (sini2 * (1.0 - 2.0 * cosi - 5.0 * cosi2) + 0.33333333 * (-2.0 + 4.0 * cosi + 6.0 * cosi2))
f523 = sini * (4.92187512 * sini2 * (-2.0 - 4.0 * cosi + 10.0 * cosi2) + 6.56250012 * (1.0 + 2.0 * cosi - 3.0 * cosi2))
f542 = 29.53125 * sini * (2.0 - 8.0 * cosi + cosi2 * (-12.0 + 8.0 * cosi + 10.0 * cosi2))
f543 = 29.53125 * sini * (-2.0 - 8.0 * cosi + cosi2 * (12.0 + 8.0 * cosi - 10.0 * cosi2))
k3 = k2 * aonv
k4 = k3 * aonv
k5 = k4 * aonv
d2201 = k2 * 1.7891679e-6 * f220 * (-0.306 - (ecc - 0.64) * 0.44)
d2211 = k2 * 1.7891679e-6 * 1.5 * sini2 * {_two_part(_G211, "<= 0.65")}
d3210 = k3 * 3.7393792e-7 * 1.875 * sini * (1.0 - 2.0 * cosi - 3.0 * cosi2) * {_two_part(_G310, "<= 0.65")}
d3222 = k3 * 3.7393792e-7 * -1.875 * sini * (1.0 + 2.0 * cosi - 3.0 * cosi2) * {_two_part(_G322, "<= 0.65")}
d4410 = k4 * 2.0 * 7.3636953e-9 * 35.0 * sini2 * f220 * {_two_part(_G410, "<= 0.65")}
d4422 = k4 * 2.0 * 7.3636953e-9 * 39.375 * sini2 * sini2 * {_two_part(_G422, "<= 0.65")}
d5220 = k5 * 1.1428639e-7 * f522 * {g520}
d5232 = k5 * 1.1428639e-7 * f523 * {_two_part(_G532, "< 0.7")}
d5421 = k5 * 2.0 * 2.1765803e-9 * f542 * {_two_part(_G521, "< 0.7")}
d5433 = k5 * 2.0 * 2.1765803e-9 * f543 * {_two_part(_G533, "< 0.7")}
lam0 = CASE WHEN class = 1 THEN mean + node + argp - gsto ELSE mean + 2.0 * node - 2.0 * gsto END % {TWO_PI!r}
lamdot = CASE WHEN class = 1 THEN mdot + argpdot + nodedot - {EARTH_RATE!r} + dmdt + domdt + dnodt - no ELSE mdot + dmdt + 2.0 * (nodedot + dnodt - {EARTH_RATE!r}) - no END
"""


# Resonance terms as (coefficient, multiple of argument of perigee,
# multiple of longitude, phase) for class 2, (coefficient, multiple, phase) for class 1.
_TERMS_1 = [("del1", 1, 0.13130908), ("del2", 2, 2.8843198), ("del3", 3, 0.37448087)]
_TERMS_2 = [
    ("d2201", 2, 1, 5.7686396), ("d2211", 0, 1, 5.7686396), ("d3210", 1, 1, 0.95240898),
    ("d3222", -1, 1, 0.95240898), ("d4410", 2, 2, 1.8014998), ("d4422", 0, 2, 1.8014998),
    ("d5220", 1, 1, 1.0508330), ("d5232", -1, 1, 1.0508330), ("d5421", 1, 2, 4.4108898),
    ("d5433", -1, 2, 4.4108898),
]
STEP = 720.0


def _rates(state: str) -> tuple[str, str, str]:
    """Rate of the longitude, of the mean motion, and its second derivative, at an integration state."""
    lam, at = f"{state}.lam", f"{state}.at"
    omega = f"(argp + argpdot * {at})"
    one = [(c, m, f"{m} * ({lam} - {ph!r})") for c, m, ph in _TERMS_1]
    two = [(c, m, f"{a} * {omega} + {m} * {lam} - {ph!r}") for c, a, m, ph in _TERMS_2]

    def total(fn: str, weighted: bool, terms) -> str:
        return "(" + " + ".join(f"{m if weighted else 1} * {c} * {fn}({angle})" for c, m, angle in terms) + ")"

    slow = f"CASE WHEN class = 1 THEN {total('sin', False, one)} ELSE {total('sin', False, two)} END"
    bend = f"CASE WHEN class = 1 THEN {total('cos', True, one)} ELSE {total('cos', True, two)} END"
    turn = f"({state}.n + lamdot)"
    return turn, f"({slow})", f"(({bend}) * {turn})"


def _harmonics() -> str:
    """The resonance terms by multiple of the longitude, for `_integrated`.

    The sum of c sin(m lam + a omega - phase) is P sin(m lam) + Q cos(m lam) for each m. In class 1, P and Q are fixed;
    in class 2 they are fixed sums over cosine and sine of omega and of 2 omega.
    """
    lines = [f"hp{m} = {c} * cos({m} * {ph!r})\nhq{m} = -1 * {c} * sin({m} * {ph!r})" for c, m, ph in _TERMS_1]
    for m in (1, 2):

        def total(fn: str, a: int) -> str:
            return "(" + " + ".join(f"{c} * {fn}({ph!r})" for c, a_, m_, ph in _TERMS_2 if (a_, m_) == (a, m)) + ")"

        def even(fn: str) -> str:
            return f"{total(fn, 1)} + {total(fn, -1)}"

        def odd(fn: str) -> str:
            return f"{total(fn, 1)} - {total(fn, -1)}"

        lines += [
            f"hp{m}_0 = {total('cos', 0)}", f"hp{m}_c = {even('cos')}", f"hp{m}_s = {odd('sin')}",
            f"hq{m}_0 = -1 * {total('sin', 0)}", f"hq{m}_c = -1 * ({even('sin')})", f"hq{m}_s = {odd('cos')}",
            f"hd{m}_c = {total('cos', 2)}", f"hd{m}_s = {total('sin', 2)}",
        ]
    return "\n".join(lines)


def _integrated() -> str:
    """Mean motion and longitude, integrated in steps of half a day from the epoch to the last step before `t`.

    A step takes cosine and sine of the longitude, and of omega in class 2, once; multiples follow from products.
    Arrays of one element hold what a step uses more than once.
    """
    half = STEP * STEP / 2

    def held(values: dict[str, str], name: str, use: str) -> str:
        members = ", ".join(f"'{n}', {v}" for n, v in values.items())
        return f"transform(array(named_struct({members})), {name} -> {use})[0]"

    moved = (
        f"named_struct('at', s.at + step, 'lam', s.lam + w.turn * step + w.ndot * {half!r}, "
        f"'n', s.n + w.ndot * step + w.bend * w.turn * {half!r})"
    )
    turn = "s.n + lamdot"
    one = held(
        {
            "turn": turn,
            "ndot": "hp1 * v.sl + hq1 * v.cl + hp2 * v.s2l + hq2 * v.c2l + hp3 * (v.s2l * v.cl + v.c2l * v.sl) + hq3 * (v.c2l * v.cl - v.s2l * v.sl)",
            "bend": "hp1 * v.cl - hq1 * v.sl + 2 * (hp2 * v.c2l - hq2 * v.s2l) "
            "+ 3 * (hp3 * (v.c2l * v.cl - v.s2l * v.sl) - hq3 * (v.s2l * v.cl + v.c2l * v.sl))",
        }, "w", moved,
    )
    one = held({"cl": "u.cl", "sl": "u.sl", "c2l": "u.cl * u.cl - u.sl * u.sl", "s2l": "2 * u.sl * u.cl"}, "v", one)
    one = held({"cl": "cos(s.lam)", "sl": "sin(s.lam)"}, "u", one)
    two = held(
        {
            "turn": turn,
            "ndot": "v.p1 * v.sl + v.q1 * v.cl + v.p2 * v.s2l + v.q2 * v.c2l",
            "bend": "v.p1 * v.cl - v.q1 * v.sl + 2 * (v.p2 * v.c2l - v.q2 * v.s2l)",
        }, "w", moved,
    )
    sums = {
        f"{x}{m}": f"h{x}{m}_0 + h{x}{m}_c * u.c + h{x}{m}_s * u.s + " + form.format(m=m)
        for m in (1, 2)
        for x, form in (("p", "hd{m}_c * u.c2 + hd{m}_s * u.s2"), ("q", "hd{m}_c * u.s2 - hd{m}_s * u.c2"))
    }
    two = held({"cl": "u.cl", "sl": "u.sl", "c2l": "u.cl * u.cl - u.sl * u.sl", "s2l": "2 * u.sl * u.cl", **sums}, "v", two)
    two = held(
        {"cl": "o.cl", "sl": "o.sl", "c": "o.c", "s": "o.s", "c2": "o.c * o.c - o.s * o.s", "s2": "2 * o.s * o.c"}, "u", two
    )
    omega = "argp + argpdot * s.at"
    two = held({"cl": "cos(s.lam)", "sl": "sin(s.lam)", "c": f"cos({omega})", "s": f"sin({omega})"}, "o", two)
    steps = f"CASE WHEN abs(t) >= {STEP!r} THEN sequence(1, CAST(floor(abs(t) / {STEP!r}) AS INT)) ELSE CAST(array() AS ARRAY<INT>) END"
    start = "named_struct('at', 0.0, 'lam', lam0, 'n', no)"
    return f"""
res = CASE class WHEN 1 THEN aggregate({steps}, {start}, (s, i) -> {one}) WHEN 2 THEN aggregate({steps}, {start}, (s, i) -> {two}) ELSE {start} END
"""


def _resonant() -> str:
    """The rest of the way to `t`, and the secular effects of sun and moon."""
    turn_e, ndot_e, nddot_e = _rates("res")
    return f"""
left_over = t - res.at
n_res = res.n + {ndot_e} * left_over + {nddot_e} * left_over * left_over * 0.5
lam_res = res.lam + {turn_e} * left_over + {ndot_e} * left_over * left_over * 0.5
theta = (gsto + t * {EARTH_RATE!r}) % {TWO_PI!r}
deep_argp = argp_1 + domdt * t
deep_node = node_m + dnodt * t
deep_mean = CASE class WHEN 1 THEN lam_res - deep_node - deep_argp + theta WHEN 2 THEN lam_res - 2.0 * deep_node + 2.0 * theta ELSE mean_1 + dmdt * t END
deep_n = CASE WHEN class > 0 THEN n_res ELSE no END
"""


def _drag(g: Gravity) -> str:
    return f"""
n_1 = CASE WHEN deep THEN deep_n ELSE no END
argp_2 = CASE WHEN deep THEN deep_argp ELSE argp_1 END
node_2 = CASE WHEN deep THEN deep_node ELSE node_m END
mean_2 = CASE WHEN deep THEN deep_mean ELSE mean_1 END
incl_2 = CASE WHEN deep THEN incl + didt * t ELSE incl END
ecc_drag = CASE WHEN deep THEN ecc + dedt * t ELSE ecc END - tempe
am = pow({g.xke!r} / n_1, 2.0 / 3.0) * tempa * tempa
fails = n_1 <= 0.0 OR ecc_drag >= 1.0 OR ecc_drag < -0.001
ecc_2 = greatest(ecc_drag, 1.0e-6)
mean_3 = mean_2 + no * templ
lon_3 = (mean_3 + argp_2 + node_2) % {TWO_PI!r}
node_3 = node_2 % {TWO_PI!r}
argp_3 = argp_2 % {TWO_PI!r}
mean_4 = (lon_3 - argp_3 - node_3) % {TWO_PI!r}
"""


# Low inclinations take the Lyddane form, which has no division by the sine.
_PERIODICS = f"""
pe = s_pe + l_pe
pinc = s_pi + l_pi
pl = s_pl + l_pl
pgh = s_pg + l_pg
ph = s_ph + l_ph
incl_p = incl_2 + pinc
ecc_p = ecc_2 + pe
sin_p = sin(incl_p)
cos_p = cos(incl_p)
steep = incl_p >= 0.2
alf = sin_p * sin(node_3) + ph * cos(node_3) + pinc * cos_p * sin(node_3)
bet = sin_p * cos(node_3) - ph * sin(node_3) + pinc * cos_p * cos(node_3)
xls = mean_4 + argp_3 + cos_p * node_3 + pl + pgh - pinc * node_3 * sin_p
node_raw = atan2(alf, bet)
node_low = CASE WHEN abs(node_3 - node_raw) <= {math.pi!r} THEN node_raw WHEN node_raw < node_3 THEN node_raw + {TWO_PI!r} ELSE node_raw - {TWO_PI!r} END
mean_p = mean_4 + pl
node_p = CASE WHEN steep THEN node_3 + ph / sin_p ELSE node_low END
argp_p = CASE WHEN steep THEN argp_3 + pgh - cos_p * ph / sin_p ELSE xls - mean_p - cos_p * node_low END
"""


def _long_period(g: Gravity) -> str:
    j3oj2 = g.j3 / g.j2
    return f"""
turned = deep AND incl_p < 0.0
inc = CASE WHEN deep THEN abs(incl_p) ELSE incl_2 END
nod = CASE WHEN turned THEN node_p + {math.pi!r} WHEN deep THEN node_p ELSE node_3 END
arg = CASE WHEN turned THEN argp_p - {math.pi!r} WHEN deep THEN argp_p ELSE argp_3 END
mea = CASE WHEN deep THEN mean_p ELSE mean_4 END
ec = CASE WHEN deep THEN ecc_p ELSE ecc_2 END
sin_i = sin(inc)
cos_i = cos(inc)
aycof = -0.5 * {j3oj2!r} * sin_i
xlcof = -0.25 * {j3oj2!r} * sin_i * (3.0 + 5.0 * cos_i) / CASE WHEN abs(cos_i + 1.0) > 1.5e-12 THEN 1.0 + cos_i ELSE 1.5e-12 END
axnl = ec * cos(arg)
inv = 1.0 / nullif(am * (1.0 - ec * ec), 0.0)
aynl = ec * sin(arg) + inv * aycof
u = (mea + arg + inv * xlcof * axnl) % {TWO_PI!r}
"""


# Ten rounds of Newton's method on Kepler's equation.
_KEPLER = """
ea = aggregate(sequence(1, 10), u, (e, i) -> e + greatest(-0.95, least(0.95, (u - aynl * cos(e) + axnl * sin(e) - e) / nullif(1.0 - cos(e) * axnl - sin(e) * aynl, 0.0))))
"""


def _short_period(g: Gravity) -> str:
    return f"""
ecose = axnl * cos(ea) + aynl * sin(ea)
esine = axnl * sin(ea) - aynl * cos(ea)
el2 = axnl * axnl + aynl * aynl
plat = am * (1.0 - el2)
rl = am * (1.0 - ecose)
betal = sqrt(1.0 - el2)
es = esine / (1.0 + betal)
sinu = am / nullif(rl, 0.0) * (sin(ea) - aynl - axnl * es)
cosu = am / nullif(rl, 0.0) * (cos(ea) - axnl + aynl * es)
sin2u = 2.0 * cosu * sinu
cos2u = 1.0 - 2.0 * sinu * sinu
q1 = 0.5 * {g.j2!r} / nullif(plat, 0.0)
q2 = q1 / nullif(plat, 0.0)
k41 = 3.0 * cos_i * cos_i - 1.0
k1m = 1.0 - cos_i * cos_i
k7m = 7.0 * cos_i * cos_i - 1.0
rk = rl * (1.0 - 1.5 * q2 * betal * k41) + 0.5 * q1 * k1m * cos2u
uk = atan2(sinu, cosu) - 0.25 * q2 * k7m * sin2u
nk = nod + 1.5 * q2 * cos_i * sin2u
ik = inc + 1.5 * q2 * cos_i * sin_i * cos2u
broken = fails OR ec < 0.0 OR ec > 1.0 OR plat < 0.0
xu = -sin(nk) * cos(ik) * sin(uk) + cos(nk) * cos(uk)
yu = cos(nk) * cos(ik) * sin(uk) + sin(nk) * cos(uk)
zu = sin(ik) * sin(uk)
"""


# Columns of `constants`: the orbit's own as a struct, and what instants read.
GIVEN = "given"
CONSTANTS = (
    "given usable epoch_day bstar ecc incl node argp mean no deep simple mdot argpdot nodedot nodecf "
    "omgcof xmcof eta delmo cc1 cc1sq cc4 cc5 d2 d3 d4 "
    "gsto class lam0 lamdot del1 del2 del3 d2201 d2211 d3210 d3222 d4410 d4422 d5220 d5232 d5421 d5433 "
    "dedt didt dmdt domdt dnodt "
    "s_m0 se2 se3 si2 si3 sl2 sl3 sl4 sgh2 sgh3 sgh4 sh2 sh3 "
    "l_m0 le2 le3 li2 li3 ll2 ll3 ll4 lgh2 lgh3 lgh4 lh2 lh3"
).split()


def constants(orbits: DataFrame, gravity: Gravity = WGS84) -> DataFrame:
    """What the model needs of an orbit at any instant. The orbit's columns move into `given`.

    `orbits` has the columns of `tle.elements`.
    """
    # The generator parts the model from the table below: rules that look for a scan would take all its lines apart.
    held = orbits.select(F.explode(F.array(F.struct("*"))).alias(GIVEN))
    usable = F.col(f"{GIVEN}.usable")
    df = held.select(
        GIVEN,
        usable.alias("usable"),
        F.when(usable, F.col(f"{GIVEN}.epoch_day")).alias("epoch_day"),
        F.col(f"{GIVEN}.bstar").alias("bstar"),
        F.col(f"{GIVEN}.eccentricity").alias("ecc"),
        F.radians(f"{GIVEN}.inclination_deg").alias("incl"),
        F.radians(f"{GIVEN}.raan_deg").alias("node"),
        F.radians(f"{GIVEN}.arg_perigee_deg").alias("argp"),
        F.radians(f"{GIVEN}.mean_anomaly_deg").alias("mean"),
        F.when(usable, F.col(f"{GIVEN}.mean_motion") * (TWO_PI / 1440.0)).alias("kozai"),
    )
    df = _stage(df, _initial(gravity))
    df = _stage(df, _THIRD_BODIES, "deep")
    df = _stage(df, _third_body("s", 2.9864797e-6, ZES) + _third_body("l", 4.7968065e-7, ZEL), "deep")
    df = _stage(df, _third_body_rates("s", ZNS) + _third_body_rates("l", ZNL), "deep")
    return _stage(df, _resonance(gravity), "deep").select(CONSTANTS)


def at_minutes(orbits: DataFrame, minutes: str, gravity: Gravity = WGS84) -> DataFrame:
    """Positions of orbits with their constants, `minutes` after the epoch of the elements."""
    df = orbits.withColumn("t", F.expr(f"CASE WHEN usable THEN CAST({minutes} AS DOUBLE) END"))
    df = _stage(df, _SECULAR)
    df = _stage(df, f"step = sign(t) * {STEP!r}\n" + _harmonics(), "deep")
    df = _stage(df, _integrated(), "deep")
    df = _stage(df, _resonant(), "deep")
    df = _stage(df, _drag(gravity))
    df = _stage(df, _third_body_periodics("s", ZNS, ZES) + _third_body_periodics("l", ZNL, ZEL), "deep")
    df = _stage(df, _PERIODICS, "deep")
    df = _stage(df, _long_period(gravity))
    df = _stage(df, _KEPLER)
    df = _stage(df, _short_period(gravity))
    axes = [F.expr(f"CASE WHEN NOT broken THEN rk * {a}u * {gravity.radius!r}D END").alias(f"{a}_km") for a in "xyz"]
    # A generator ends the chain: filters on the result are not rewritten into the model.
    return df.select(GIVEN, F.explode(F.array(F.struct(*axes))).alias("place")).select(f"{GIVEN}.*", "place.*")


def propagate(orbits: DataFrame, minutes: str, gravity: Gravity = WGS84) -> DataFrame:
    """Add `x_km, y_km, z_km` in the equatorial frame, null where the model breaks down.

    `orbits` has the columns of `tle.elements`; `minutes` is an expression for the time
    since the epoch of the elements, from the columns of the orbit.
    """
    timed = constants(orbits.withColumn("minutes_", F.expr(minutes)), gravity)
    return at_minutes(timed, f"{GIVEN}.minutes_", gravity).drop("minutes_")
