"""Projections and derived columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventloom.functions import calibration, clocks, decays, muons, tracks, vertices
from eventloom.operators import tables
from eventloom.operators.ordered import blocked
from eventloom.plans.derived import decays as decay_table
from eventloom.plans.derived import vector
from eventloom.plans.domain import base, table
from eventloom.plans.registry import query, r6

C = F.col


@query("b01_project_by_label", "SELECT obj_id, tgl, snp FROM tracks", ("tracks",))
def project_by_label(spark, sf):
    return tables.project(table(spark, sf, "tracks"), ["obj_id", "tgl", "snp"])


@query(
    "b02_persistent_projection",
    "SELECT file_id, event_idx, obj_id, snp, signed1pt FROM tracks",
    ("tracks",),
)
def persistent_projection(spark, sf):
    stored = ["file_id", "event_idx", "obj_id", "snp", "signed1pt"]
    df = table(spark, sf, "tracks").select(*stored).withColumn("pt", tracks.pt(C("signed1pt")))
    return tables.persistent(df, stored)


@query(
    "b03_derived_column_with_argument",
    "SELECT event_idx, obj_id, r6(x * cos(0.35) + y * sin(0.35)) AS rotated FROM tracks",
    ("tracks",),
)
def derived_column(spark, sf):
    def rotated(x, y, angle):
        return r6(x * F.cos(F.lit(angle)) + y * F.sin(F.lit(angle)))

    df = tables.derive(table(spark, sf, "tracks"), "rotated", rotated, "x", "y", angle=0.35)
    return df.select("event_idx", "obj_id", "rotated")


@query(
    "b04_flat_track_kinematics",
    """SELECT event_idx, obj_id, r6(asin(snp) + alpha + pi()) AS phi_flat,
         r6(ln(tan(pi() / 4 - atan(tgl) / 2))) AS eta_flat,
         CASE WHEN signed1pt <> 0 THEN r6(abs(1 / signed1pt)) END AS pt
       FROM tracks""",
    ("tracks",),
)
def flat_kinematics(spark, sf):
    return table(spark, sf, "tracks").select(
        "event_idx",
        "obj_id",
        r6(tracks.phi_flat(C("snp"), C("alpha"))).alias("phi_flat"),
        r6(tracks.eta_flat(C("tgl"))).alias("eta_flat"),
        r6(tracks.pt(C("signed1pt"))).alias("pt"),
    )


@query(
    "b05_define_column",
    """SELECT file_id, event_idx, obj_id, CASE WHEN signed1pt <> 0 THEN r6(abs(1 / signed1pt)) END AS pt
       FROM tracks""",
    ("tracks",),
)
def define_column(spark, sf):
    df = table(spark, sf, "tracks").withColumn("pt", r6(F.expr("abs(try_divide(1D, signed1pt))")))
    return df.select("file_id", "event_idx", "obj_id", "pt")


@query(
    "b06_event_model_kinematics",
    """WITH k AS (SELECT *, asin(snp) + alpha AS raw_phi FROM tracks)
       SELECT event_idx, obj_id,
         CASE WHEN signed1pt <> 0 THEN r6(sqrt(1 + tgl * tgl) / abs(signed1pt)) END AS p,
         r6(abs(signed1pt) / sqrt(1 + tgl * tgl)) AS inverse_p,
         r6(pi() / 2 - atan(tgl)) AS theta,
         r6(CASE WHEN raw_phi < 0 THEN raw_phi + 2 * pi() WHEN raw_phi >= 2 * pi() THEN raw_phi - 2 * pi()
              ELSE raw_phi END) AS phi,
         r6(-ln(tan((pi() / 2 - atan(tgl)) / 2))) AS eta
       FROM k""",
    ("tracks",),
)
def event_model_kinematics(spark, sf):
    return table(spark, sf, "tracks").select(
        "event_idx",
        "obj_id",
        r6(tracks.momentum(C("tgl"), C("signed1pt"))).alias("p"),
        r6(tracks.inverse_momentum(C("tgl"), C("signed1pt"))).alias("inverse_p"),
        r6(tracks.theta(C("tgl"))).alias("theta"),
        r6(tracks.phi(C("snp"), C("alpha"))).alias("phi"),
        r6(tracks.eta(C("tgl"))).alias("eta"),
    )


@query(
    "b07_local_to_global",
    """WITH g AS (SELECT event_idx, obj_id, x * cos(alpha) - y * sin(alpha) AS gx,
           x * sin(alpha) + y * cos(alpha) AS gy, sqrt((1 - snp) * (1 + snp)) AS r, snp, tgl, alpha,
           CASE WHEN signed1pt <> 0 THEN abs(1 / signed1pt) END AS pt FROM tracks)
       SELECT event_idx, obj_id, r6(gx) AS gx, r6(gy) AS gy,
         r6(pt * (r * cos(alpha) - snp * sin(alpha))) AS px,
         r6(pt * (r * sin(alpha) + snp * cos(alpha))) AS py, r6(pt * tgl) AS pz,
         r6(CASE WHEN atan2(gy, gx) < 0 THEN atan2(gy, gx) + 2 * pi() ELSE atan2(gy, gx) END) AS phi_pos
       FROM g""",
    ("tracks",),
)
def local_to_global(spark, sf):
    gx, gy = tracks.global_position(C("x"), C("y"), C("alpha"))
    px, py, pz = tracks.global_momentum(C("snp"), C("tgl"), C("signed1pt"), C("alpha"))
    return table(spark, sf, "tracks").select(
        "event_idx",
        "obj_id",
        r6(gx).alias("gx"),
        r6(gy).alias("gy"),
        r6(px).alias("px"),
        r6(py).alias("py"),
        r6(pz).alias("pz"),
        r6(tracks.position_phi(C("x"), C("y"), C("alpha"))).alias("phi_pos"),
    )


@query(
    "b08_impact_parameters",
    """WITH f AS (SELECT *, CASE WHEN event_idx % 4 = 0 THEN 0.0::DOUBLE ELSE 5.0::DOUBLE END AS b FROM tracks),
       v AS (SELECT *, x - (0.1 * cos(alpha) + 0.2 * sin(alpha)) AS xt, y - (-0.1 * sin(alpha) + 0.2 * cos(alpha)) AS yt,
         sqrt((1 - snp) * (1 + snp)) AS r1, signed1pt * b * -0.299792458e-3 AS c FROM f),
       h AS (SELECT *, c * xt - snp AS sn, c * yt + r1 AS cs,
         2 * (xt * snp - yt * r1) - c * (xt * xt + yt * yt) AS a FROM v),
       w AS (SELECT *, sqrt(sn * sn + cs * cs) AS rr FROM h)
       SELECT event_idx, obj_id,
         r6(CASE WHEN b = 0 THEN -(xt * snp - yt * r1) ELSE -a / (1 + rr) END) AS d,
         r6(CASE WHEN b = 0 OR abs(c) < 1.17549435e-38 THEN -(xt * snp - yt * r1) ELSE -a / (1 + rr) END) AS dz0,
         r6(CASE WHEN b = 0 OR abs(c) < 1.17549435e-38
              THEN z + (-(xt * snp - yt * r1) * snp - xt) / r1 * tgl - 0.3
              ELSE z + tgl / c * asin((-sn / rr) * r1 - snp * sqrt((1 + sn / rr) * (1 - sn / rr))) - 0.3 END) AS dz1
       FROM w""",
    ("tracks",),
)
def impact_parameters(spark, sf):
    df = table(spark, sf, "tracks").withColumn("b", F.when(C("event_idx") % 4 == 0, 0.0).otherwise(5.0))
    at = (F.lit(0.1), F.lit(0.2))
    dz = tracks.impact_dz(
        C("x"), C("y"), C("z"), C("alpha"), C("snp"), C("tgl"), C("signed1pt"), *at, F.lit(0.3), C("b")
    )
    return df.select(
        "event_idx",
        "obj_id",
        r6(tracks.impact(C("x"), C("y"), C("alpha"), C("snp"), C("signed1pt"), *at, C("b"))).alias("d"),
        r6(dz[0]).alias("dz0"),
        r6(dz[1]).alias("dz1"),
    )


def _muon_sql(suffix: str) -> str:
    name = suffix or "_vtx"
    pz = (
        f"-(CASE WHEN inv_bending{suffix} <> 0 THEN abs(1 / inv_bending{suffix}) END)"
        f" / sqrt(1 + tan(theta_y{suffix}) * tan(theta_y{suffix}))"
    )
    p2 = f"(({pz}) * ({pz}) * (1 + tan(theta_x{suffix}) ** 2 + tan(theta_y{suffix}) ** 2))"
    return (
        f"r6(({pz}) * tan(theta_x{suffix})) AS px{name}, r6(({pz}) * tan(theta_y{suffix})) AS py{name},"
        f" r6({pz}) AS pz{name}, r6(sqrt({p2})) AS p{name}, r6(sqrt({p2} + 0.105658369 * 0.105658369)) AS e{name}"
    )


_MUON_STATES = ("", "_dca", "_uncor")


@query(
    "b09_muon_kinematics",
    f"SELECT event_idx, obj_id, {', '.join(_muon_sql(s) for s in _MUON_STATES)} FROM muons",
    ("muons",),
)
def muon_kinematics(spark, sf):
    columns = []
    for state in _MUON_STATES:
        values = muons.momentum(C(f"inv_bending{state}"), C(f"theta_x{state}"), C(f"theta_y{state}"))
        columns += [r6(v).alias(f"{n}{state or '_vtx'}") for n, v in zip(("px", "py", "pz", "p", "e"), values)]
    return table(spark, sf, "muons").select("event_idx", "obj_id", *columns)


@query(
    "b10_chi2_per_cluster",
    """SELECT event_idx, obj_id, r6(CASE WHEN its_ncls > 0 THEN its_chi2 / its_ncls ELSE 0 END) AS its_chi2_ncl,
         r6(CASE WHEN tpc_ncls > 0 THEN tpc_chi2 / tpc_ncls ELSE 0 END) AS tpc_chi2_ncl,
         r6(coalesce(inner_p, 0)) AS inner_p
       FROM tracks_extra""",
    ("tracks_extra",),
)
def chi2_per_cluster(spark, sf):
    return table(spark, sf, "tracks_extra").select(
        "event_idx",
        "obj_id",
        r6(tracks.per_cluster(C("its_chi2"), C("its_ncls"))).alias("its_chi2_ncl"),
        r6(tracks.per_cluster(C("tpc_chi2"), C("tpc_ncls"))).alias("tpc_chi2_ncl"),
        r6(F.coalesce("inner_p", F.lit(0.0))).alias("inner_p"),
    )


@query(
    "b11_normalised_chi2",
    """SELECT event_idx, obj_id, greatest(2 * nhit - 5, 0) AS ndf,
         r6(CASE WHEN 2 * nhit - 5 > 0 THEN chi2 / (2 * nhit - 5) ELSE 0 END) AS chi2_ndf
       FROM muons""",
    ("muons",),
)
def normalised_chi2(spark, sf):
    return table(spark, sf, "muons").select(
        "event_idx",
        "obj_id",
        muons.degrees_of_freedom(C("nhit")).alias("ndf"),
        r6(muons.normalised_chi2(C("chi2"), C("nhit"))).alias("chi2_ndf"),
    )


@query(
    "b12_trigger_match_level",
    """SELECT event_idx, obj_id, CASE WHEN (local_trigger & 255) = 0 THEN 0
         WHEN ((local_trigger >> 22) & 3) = 0 AND ((local_trigger >> 24) & 3) = 0 THEN 1
         WHEN ((local_trigger >> 24) & 3) = 0 THEN 2 ELSE 3 END AS match_trigger
       FROM muons""",
    ("muons",),
)
def trigger_match_level(spark, sf):
    def bits(shift, mask):
        return F.shiftright("local_trigger", shift).bitwiseAND(F.lit(mask))

    return table(spark, sf, "muons").select(
        "event_idx", "obj_id", muons.trigger_match(bits(0, 255), bits(22, 3), bits(24, 3)).alias("match_trigger")
    )


@query(
    "b13_row_range",
    "SELECT o_orderkey AS obj_idx, o_custkey AS custkey FROM orders WHERE o_orderkey BETWEEN 100 AND 4999",
)
def row_range(spark, sf):
    df = base(spark, sf, "orders").select(C("o_orderkey").alias("obj_idx"), C("o_custkey").alias("custkey"))
    return tables.row_range(df, 100, 4999)


@query(
    "b14_pair_and_triple_kinematics",
    """WITH s AS (SELECT *, ppx + npx AS vx, ppy + npy AS vy, ppz + npz AS vz, ppx + npx + bpx AS cx,
         ppy + npy + bpy AS cy, ppz + npz + bpz AS cz FROM decays),
       e AS (SELECT *, sqrt(0.497614 ** 2 + vx * vx + vy * vy + vz * vz) AS ev,
         sqrt(1.32171 ** 2 + cx * cx + cy * cy + cz * cz) AS ec FROM s)
       SELECT event_idx, r6(sqrt(vx * vx + vy * vy + vz * vz)) AS pair_p, r6(ev) AS pair_e,
         r6(0.5 * ln((ev + vz) / (ev - vz + 1e-13))) AS pair_y,
         r6(sqrt(cx * cx + cy * cy + cz * cz)) AS triple_p, r6(ec) AS triple_e,
         r6(0.5 * ln((ec + cz) / (ec - cz + 1e-13))) AS triple_y
       FROM e""",
    ("decays",),
)
def pair_kinematics(spark, sf):
    pair = decays.add(vector("pp"), vector("np"))
    triple = decays.add(pair, vector("bp"))
    k0s, xi = decays.MASSES["k0s"], decays.MASSES["xi"]
    return decay_table(spark, sf).select(
        "event_idx",
        r6(decays.norm(pair)).alias("pair_p"),
        r6(decays.energy(pair, k0s)).alias("pair_e"),
        r6(decays.rapidity(pair, k0s)).alias("pair_y"),
        r6(decays.norm(triple)).alias("triple_p"),
        r6(decays.energy(triple, xi)).alias("triple_e"),
        r6(decays.rapidity(triple, xi)).alias("triple_y"),
    )


@query(
    "b15_armenteros",
    """WITH s AS (SELECT *, ppx + npx AS vx, ppy + npy AS vy, ppz + npz AS vz, ppx + npx + bpx AS cx,
         ppy + npy + bpy AS cy, ppz + npz + bpz AS cz FROM decays),
       m AS (SELECT *, sqrt(vx * vx + vy * vy + vz * vz) AS v, sqrt(cx * cx + cy * cy + cz * cz) AS c FROM s),
       l AS (SELECT *, (ppx * vx + ppy * vy + ppz * vz) / v AS lp, (npx * vx + npy * vy + npz * vz) / v AS ln_,
         (bpx * cx + bpy * cy + bpz * cz) / c AS lb, (vx * cx + vy * cy + vz * cz) / c AS lv FROM m)
       SELECT event_idx, r6((lp - ln_) / (lp + ln_)) AS alpha_pair,
         r6(sqrt((npy * vz - npz * vy) ** 2 + (npz * vx - npx * vz) ** 2 + (npx * vy - npy * vx) ** 2) / v) AS pt_pair,
         r6((lv - lb) / (lv + lb)) AS alpha_cascade,
         r6(sqrt((bpy * cz - bpz * cy) ** 2 + (bpz * cx - bpx * cz) ** 2 + (bpx * cy - bpy * cx) ** 2) / c) AS pt_cascade
       FROM l""",
    ("decays",),
)
def armenteros(spark, sf):
    pos, neg, bach = vector("pp"), vector("np"), vector("bp")
    pair = decays.add(pos, neg)
    triple = decays.add(pair, bach)
    return decay_table(spark, sf).select(
        "event_idx",
        r6(decays.armenteros_alpha(pos, neg)).alias("alpha_pair"),
        r6(decays.armenteros_pt(neg, pair)).alias("pt_pair"),
        r6(decays.armenteros_alpha(pair, bach)).alias("alpha_cascade"),
        r6(decays.armenteros_pt(bach, triple)).alias("pt_cascade"),
    )


@query(
    "b16_invariant_mass",
    """WITH s AS (SELECT event_idx,
         CASE WHEN event_idx % 2 = 0 THEN ppx ELSE npx END AS ax, CASE WHEN event_idx % 2 = 0 THEN ppy ELSE npy END AS ay,
         CASE WHEN event_idx % 2 = 0 THEN ppz ELSE npz END AS az, CASE WHEN event_idx % 2 = 0 THEN npx ELSE ppx END AS bx,
         CASE WHEN event_idx % 2 = 0 THEN npy ELSE ppy END AS by_, CASE WHEN event_idx % 2 = 0 THEN npz ELSE ppz END AS bz
         FROM decays)
       SELECT event_idx, r6(sqrt(greatest(0.938272046 ** 2 + 0.13957018 ** 2 + 2 * (
         sqrt(0.938272046 ** 2 + ax * ax + ay * ay + az * az) * sqrt(0.13957018 ** 2 + bx * bx + by_ * by_ + bz * bz)
         - (ax * bx + ay * by_ + az * bz)), 0))) AS mass
       FROM s""",
    ("decays",),
)
def invariant_mass(spark, sf):
    straight = C("event_idx") % 2 == 0
    pos, neg = vector("pp"), vector("np")
    first = tuple(F.when(straight, p).otherwise(n) for p, n in zip(pos, neg))
    second = tuple(F.when(straight, n).otherwise(p) for p, n in zip(pos, neg))
    mass = decays.pair_mass(first, second, decays.MASSES["proton"], decays.MASSES["pion"])
    return decay_table(spark, sf).select("event_idx", r6(mass).alias("mass"))


def _pair_sql(code: int) -> str:
    plus, minus, parent, ps = decays.PAIR_HYPOTHESES[code]
    mp, mn, m = decays.MASSES[plus], decays.MASSES[minus], decays.MASSES[parent]
    return f"""SELECT event_idx, {code} AS code,
      r6(sqrt(greatest((en + ep) ** 2 - pl * pl, 0))) AS mass,
      r6(0.25 * (pl / (en + ep)) ** 2 * {m} ** 2 * ((plp - pln) / (plp + pln) - ({mp} ** 2 - {mn} ** 2) / {m} ** 2) ** 2
         + pp2 - plp * plp - {ps} ** 2) AS quality
    FROM (SELECT *, sqrt({mn} ** 2 + nn2) AS en, sqrt({mp} ** 2 + pp2) AS ep FROM l) q"""


_LEGS_SQL = """WITH s AS (SELECT *, ppx + npx AS vx, ppy + npy AS vy, ppz + npz AS vz,
      ppx * ppx + ppy * ppy + ppz * ppz AS pp2, npx * npx + npy * npy + npz * npz AS nn2 FROM decays),
    m AS (SELECT *, sqrt(vx * vx + vy * vy + vz * vz) AS pl FROM s),
    l AS (SELECT *, (ppx * vx + ppy * vy + ppz * vz) / pl AS plp, (npx * vx + npy * vy + npz * vz) / pl AS pln FROM m) """


def _cascade_sql(code: int) -> str:
    mp, mn, mb, m, ps = decays.CASCADE_HYPOTHESES[code]
    return f"""SELECT event_idx, {code} AS code,
      r6(sqrt(greatest((e0 + eb - pc) * (e0 + eb + pc), 0))) AS mass,
      r6(0.25 * (pc / (e0 + eb)) ** 2 * {m} ** 2
         * ((pl0 - plb) / (pl0 + plb) - (1.11568 ** 2 - {mb} ** 2) / {m} ** 2) ** 2
         + pl * pl - pl0 * pl0 - {ps} ** 2) AS quality,
      r6(0.25 * (pl / e0) ** 2 * 1.11568 ** 2 * ((plp - pln) / (plp + pln) - ({mp} ** 2 - {mn} ** 2) / 1.11568 ** 2) ** 2
         + pp2 - plp * plp - 0.101 ** 2) AS pair_quality
    FROM (SELECT *, sqrt(1.11568 ** 2 + pl * pl) AS e0, sqrt({mb} ** 2 + bpx * bpx + bpy * bpy + bpz * bpz) AS eb,
            (vx * cx + vy * cy + vz * cz) / pc AS pl0, (bpx * cx + bpy * cy + bpz * cz) / pc AS plb
          FROM (SELECT *, sqrt(cx * cx + cy * cy + cz * cz) AS pc
                FROM (SELECT *, vx + bpx AS cx, vy + bpy AS cy, vz + bpz AS cz FROM l) q1) q2) q3"""


@query(
    "b17_pair_mass_hypotheses",
    _LEGS_SQL + " UNION ALL ".join(_pair_sql(c) for c in decays.PAIR_HYPOTHESES),
    ("decays",),
)
def pair_hypotheses(spark, sf):
    df, inner = _staged(decay_table(spark, sf), "i_", vector("pp"), vector("np"))
    tested = []
    for code in decays.PAIR_HYPOTHESES:
        mass, quality = decays.pair_hypothesis(inner, code)
        tested.append(F.struct(F.lit(code).alias("code"), r6(mass).alias("mass"), r6(quality).alias("quality")))
    return df.select("event_idx", F.inline(F.array(*tested)))


def _staged(df, prefix, first, second):
    """The shared two-body quantities as columns, computed once for all hypotheses."""
    shared = decays.two_body(first, second)
    return df.withColumns({f"{prefix}{n}": v for n, v in shared.items()}), {n: C(f"{prefix}{n}") for n in shared}


@query(
    "b17_cascade_mass_hypotheses",
    _LEGS_SQL + " UNION ALL ".join(_cascade_sql(c) for c in decays.CASCADE_HYPOTHESES),
    ("decays",),
)
def cascade_hypotheses(spark, sf):
    pos, neg = vector("pp"), vector("np")
    df, inner = _staged(decay_table(spark, sf), "i_", pos, neg)
    df, outer = _staged(df, "o_", decays.add(pos, neg), vector("bp"))
    tested = []
    for code in decays.CASCADE_HYPOTHESES:
        values = decays.cascade_hypothesis(inner, outer, code)
        names = ("mass", "quality", "pair_quality")
        tested.append(F.struct(F.lit(code).alias("code"), *[r6(v).alias(n) for v, n in zip(values, names)]))
    return df.select("event_idx", F.inline(F.array(*tested)))


@query(
    "b18_impact_and_pointing",
    """WITH s AS (SELECT d.*, c.x, c.y, c.z, ppx + npx AS px, ppy + npy AS py, ppz + npz AS pz
         FROM decays d JOIN collisions c USING (file_id, event_idx))
       SELECT event_idx, r6(abs((x - sx) * py - (y - sy) * px) / sqrt(px * px + py * py)) AS d2,
         r6(sqrt((((y - sy) * pz - (z - sz) * py) ** 2 + ((x - sx) * pz - (z - sz) * px) ** 2
            + ((x - sx) * py - (y - sy) * px) ** 2) / (px * px + py * py + pz * pz))) AS d3,
         r6(((sx - x) * px + (sy - y) * py + (sz - z) * pz) / (sqrt(px * px + py * py + pz * pz)
            * sqrt((sx - x) ** 2 + (sy - y) ** 2 + (sz - z) ** 2))) AS cos_pointing
       FROM s""",
    ("decays", "collisions"),
)
def impact_and_pointing(spark, sf):
    collisions = table(spark, sf, "collisions").select("file_id", "event_idx", "x", "y", "z")
    df = decay_table(spark, sf).join(collisions, tables.EVENT)
    at, p, point = vector("s"), decays.add(vector("pp"), vector("np")), vector("")
    return df.select(
        "event_idx",
        r6(decays.impact_2d(at, p, point)).alias("d2"),
        r6(decays.impact_3d(at, p, point)).alias("d3"),
        r6(decays.cos_pointing(at, p, point)).alias("cos_pointing"),
    )


@query(
    "b19_weighted_vertex_distance",
    """WITH s AS (SELECT event_idx, obj_id, v.vx - c.x AS dx, v.vy - c.y AS dy, v.vz - c.z AS dz,
         c.cov_xx + v.v_xx AS xx, c.cov_xy + v.v_xy AS xy, c.cov_yy + v.v_yy AS yy, c.cov_zz + v.v_zz AS zz
         FROM vertices v JOIN collisions c USING (file_id, event_idx)),
       q AS (SELECT *, (yy * dx * dx + xx * dy * dy - 2 * xy * dx * dy) / (xx * yy - xy * xy) + dz * dz / zz AS d2 FROM s)
       SELECT event_idx, obj_id, CASE WHEN d2 > 0 THEN r6(sqrt(d2)) END AS distance FROM q""",
    ("vertices", "collisions"),
)
def weighted_vertex_distance(spark, sf):
    collisions = table(spark, sf, "collisions").select(
        "file_id", "event_idx", "x", "y", "z", "cov_xx", "cov_xy", "cov_yy", "cov_zz"
    )
    df = table(spark, sf, "vertices").join(collisions, tables.EVENT)
    d = {a: C(f"v{a}") - C(a) for a in "xyz"}
    cov = {a: C(f"cov_{a}") + C(f"v_{a}") for a in ("xx", "xy", "yy", "zz")}
    return df.select("event_idx", "obj_id", r6(vertices.weighted_distance(d, cov)).alias("distance"))


@query(
    "b20_point_residual",
    """WITH s AS (SELECT event_idx, obj_id, v.vx - c.x AS dx, v.vy - c.y AS dy, (v.vz - c.z) / 100 AS dz,
         c.cov_xx + v.v_xx AS xx, c.cov_xy + v.v_xy AS xy, c.cov_yy + v.v_yy AS yy, c.cov_zz + v.v_zz AS zz,
         v.v_xy / 2 AS xz, v.v_xy / 4 AS yz
         FROM vertices v JOIN collisions c USING (file_id, event_idx)),
       t AS (SELECT *, xx * (yy * zz - yz * yz) - xy * (xy * zz - xz * yz) + xz * (xy * yz - xz * yy) AS det FROM s)
       SELECT event_idx, obj_id, r6(dx * dx + dy * dy + dz * dz) AS plain,
         r6(((yy * zz - yz * yz) * dx * dx + (xx * zz - xz * xz) * dy * dy + (xx * yy - xy * xy) * dz * dz
          + 2 * ((xz * yz - xy * zz) * dx * dy + (xy * yz - xz * yy) * dx * dz + (xy * xz - xx * yz) * dy * dz)) / det) AS weighted
       FROM t""",
    ("vertices", "collisions"),
)
def point_residual(spark, sf):
    collisions = table(spark, sf, "collisions").select(
        "file_id", "event_idx", "x", "y", "z", "cov_xx", "cov_xy", "cov_yy", "cov_zz"
    )
    df = table(spark, sf, "vertices").join(collisions, tables.EVENT)
    d = {"x": C("vx") - C("x"), "y": C("vy") - C("y"), "z": (C("vz") - C("z")) / 100}
    cov = {a: C(f"cov_{a}") + C(f"v_{a}") for a in ("xx", "xy", "yy", "zz")}
    cov |= {"xz": C("v_xy") / 2, "yz": C("v_xy") / 4}
    return df.select(
        "event_idx",
        "obj_id",
        r6(vertices.residual(d)).alias("plain"),
        r6(vertices.weighted_residual(d, cov)).alias("weighted"),
    )


# one counter start per run; a third of the runs have none
_START = {
    "run": "290000 + c_custkey % 64",
    "start_sec": "max(CASE WHEN c_custkey % 3 > 0 THEN 1500000000 + c_custkey % 1000 ELSE 0 END)",
    "start_us": "max(c_custkey % 1000000)",
    "start_orbit": "max((c_custkey % 16) * 1000000)",
    "start_period": "min(c_custkey % 64)",
    "start_bc": "max(c_custkey * 7)",
}


def _run_starts(spark, sf):
    run = F.expr(_START["run"]).alias("run")
    columns = [F.expr(e).alias(c) for c, e in _START.items() if c != "run"]
    return base(spark, sf, "customer").groupBy(run).agg(*columns)


@query(
    "b21_event_time",
    f"""WITH starts AS (SELECT {', '.join(f'{e} AS {c}' for c, e in _START.items())} FROM customer GROUP BY 1),
       j AS (SELECT c.*, start_sec, start_us, start_bc % 3564 AS bc0, orbit - start_orbit AS span0,
           orbit - start_orbit + period * 16777216 AS span,
           start_sec IS NULL OR start_sec = 0 OR (orbit - start_orbit < -10000 AND period = start_period) AS no_start
         FROM collisions c LEFT JOIN starts USING (run))
       SELECT event_idx,
         CASE WHEN no_start THEN time_stamp
              ELSE start_sec + CAST(trunc((trunc(span * 89100 / 1000) + start_us) / 1000000) AS BIGINT) END AS seconds,
         r6(CASE WHEN no_start THEN time_stamp
              ELSE start_sec + ((span * 3564 + bunch_cross - bc0) * (1 / 40.079::DOUBLE) + start_us) / 1000000 END) AS precise
       FROM j""",
    ("collisions",),
)
def event_time(spark, sf):
    df = table(spark, sf, "collisions").join(_run_starts(spark, sf), "run", "left")
    seconds, precise = clocks.event_time(
        C("orbit"), C("period"), C("bunch_cross"), C("time_stamp"),
        C("start_sec"), C("start_us"), C("start_orbit"), C("start_period"), C("start_bc"),
    )
    return df.select("event_idx", seconds.alias("seconds"), r6(precise).alias("precise"))


@query(
    "b22_tof_bunch_crossing",
    """WITH j AS (SELECT t.event_idx, t.obj_id, t.tgl, t.signed1pt, e.tof_signal, e.length, e.flags
         FROM tracks t JOIN tracks_extra e USING (file_id, event_idx, obj_id)),
       k AS (SELECT *, CASE WHEN signed1pt <> 0 THEN sqrt(1 + tgl * tgl) / abs(signed1pt) END AS p,
         signed1pt * 5.0 * -0.299792458e-3 AS c FROM j),
       m AS (SELECT *, CASE WHEN abs(c) > 1.17549435e-38 THEN 2.0 / c * asin(385.0 * c / 2) * sqrt(1 + tgl * tgl)
           ELSE 385.0 END AS path FROM k),
       d AS (SELECT *, CASE WHEN (flags & 8192) <> 0 THEN (tof_signal - coalesce(length / 0.03 * 1.1,
           CASE WHEN p >= 0.01 THEN path / 0.03 * sqrt(1 + 0.13957018 ** 2 / (p * p)) END)) * 1e-3 END AS dt FROM m)
       SELECT event_idx, obj_id, r6(dt) AS time_difference, CAST(round(dt / 25) AS INT) AS bunch FROM d""",
    ("tracks", "tracks_extra"),
)
def tof_bunch_crossing(spark, sf):
    extra = table(spark, sf, "tracks_extra").select(*tables.OBJECT, "tof_signal", "length", "flags")
    main = table(spark, sf, "tracks").select(*tables.OBJECT, "tgl", "signed1pt")
    dt = tracks.tof_time_difference(
        C("tof_signal"),
        C("length") / 0.03 * 1.1,
        F.lit(decays.MASSES["pion"]),
        C("tgl"),
        C("signed1pt"),
        F.lit(5.0),
        C("flags").bitwiseAND(F.lit(8192)) != 0,
    )
    return (
        main.join(extra, tables.OBJECT)
        .withColumn("dt", dt)
        .select("event_idx", "obj_id", r6(C("dt")).alias("time_difference"), tracks.tof_bunch(C("dt")).alias("bunch"))
    )


def _centroid_sql(corner: str, power: str) -> str:
    terms = []
    for i, sign in enumerate({"x": (-1, 1, -1, 1), "y": (-1, -1, 1, 1)}[corner]):
        terms.append(f"{sign * 1.75} * w{i}_{power}")
    return "(" + " + ".join(terms) + ")"


_WEIGHTS = ", ".join(
    f"CASE WHEN embedding[{i + 2}] > 0 THEN pow(embedding[{i + 2}]::DOUBLE, {a}) ELSE 0 END AS w{i}_{n}"
    for i in range(4)
    for n, a in (("ion", 0.395), ("pp", 0.5))
)
_SUMS = {n: " + ".join(f"w{i}_{n}" for i in range(4)) for n in ("ion", "pp")}


@query(
    "b23_neutron_centroid",
    f"""WITH w AS (SELECT vec_id, abs(embedding[1]::DOUBLE) * 100 AS e, {_WEIGHTS} FROM embeddings),
       c AS (SELECT *, 1.89358 - 0.71262 / (e / 1.38 + 0.71789) AS corr FROM w)
       SELECT vec_id,
         CASE WHEN {_SUMS['ion']} <> 0 THEN r6(corr * {_centroid_sql('x', 'ion')} / ({_SUMS['ion']})) END AS x_ion,
         CASE WHEN {_SUMS['ion']} <> 0 THEN r6(corr * {_centroid_sql('y', 'ion')} / ({_SUMS['ion']})) END AS y_ion,
         CASE WHEN {_SUMS['pp']} <> 0 THEN r6({_centroid_sql('x', 'pp')} / ({_SUMS['pp']})) END AS x_pp,
         CASE WHEN {_SUMS['pp']} <> 0 THEN r6({_centroid_sql('y', 'pp')} / ({_SUMS['pp']})) END AS y_pp
       FROM c""",
)
def neutron_centroid(spark, sf):
    df = base(spark, sf, "embeddings").select(
        "vec_id",
        (F.abs(F.col("embedding")[0].cast("double")) * 100).alias("energy"),
        F.slice("embedding", 2, 4).cast("array<double>").alias("towers"),
    )
    ion = calibration.neutron_centroid(C("towers"), C("energy"), beam_energy=1.38)
    pp = calibration.neutron_centroid(C("towers"), C("energy"))
    return df.select(
        "vec_id",
        *[r6(v).alias(f"{axis}_{n}") for n, pair in (("ion", ion), ("pp", pp)) for axis, v in zip("xy", pair)],
    )


@query(
    "b24_neutron_time",
    """WITH t AS (SELECT vec_id, label % 3 AS cabling, label % 4 <> 3 AS corrected,
         CASE WHEN embedding[17] > 0 THEN embedding[17]::DOUBLE ELSE 0 END AS ch_c,
         CASE WHEN embedding[19] > 0 THEN embedding[19]::DOUBLE ELSE 0 END AS ch_a,
         embedding[17]::DOUBLE * 10 AS tc, embedding[19]::DOUBLE * 10 AS ta FROM embeddings)
       SELECT vec_id,
         r6(CASE WHEN NOT corrected THEN 1000.0 WHEN ch_c <> 0 AND ch_a <> 0 THEN tc + ta
              WHEN cabling = 0 THEN 999.0 WHEN cabling = 1 THEN 998.0 ELSE 997.0 END) AS time_sum,
         r6(CASE WHEN NOT corrected THEN 1000.0 WHEN ch_c <> 0 AND ch_a <> 0
                   THEN CASE WHEN cabling = 2 THEN ta - tc ELSE tc - ta END
              WHEN cabling = 0 THEN 999.0 WHEN cabling = 1 THEN 998.0 ELSE 997.0 END) AS time_diff
       FROM t""",
)
def neutron_time(spark, sf):
    def raw(i):
        value = F.col("embedding")[i].cast("double")
        return F.when(value > 0, value).otherwise(0.0)

    def time(i):
        return F.col("embedding")[i].cast("double") * 10

    total, diff = calibration.neutron_times(
        raw(16), raw(18), time(16), time(18), C("label") % 4 != 3, C("label") % 3
    )
    return base(spark, sf, "embeddings").select("vec_id", r6(total).alias("time_sum"), r6(diff).alias("time_diff"))


_BEAMS = ("p-p", "Pb-Pb", "p-Pb", "Pb-p", "Xe-Xe")
_BEAM_SQL = "CASE " + " ".join(f"WHEN s_nationkey % 5 = {i} THEN '{b}'" for i, b in enumerate(_BEAMS)) + " END"


@query(
    "b25_beam_energy_scale",
    f"""WITH r AS (SELECT s_suppkey AS run, {_BEAM_SQL} AS beam, 3000 + s_acctbal / 4 AS e FROM supplier),
       n AS (SELECT *, CASE WHEN beam IN ('p-Pb', 'Pb-p') THEN 82 * e / 208 END AS en FROM r),
       q AS (SELECT *, CASE WHEN beam IN ('p-Pb', 'Pb-p') THEN
           sqrt(2 * 0.94 ** 2 + 2 * e * en * (1 + sqrt(e * e - 0.94 ** 2) * sqrt(en * en - 0.94 ** 2) / (e * en)))
           ELSE 2 * e END AS sqrts FROM n)
       SELECT run, beam, r6(sqrts) AS sqrts,
         r6(CASE beam WHEN 'p-p' THEN pow(sqrts / 13000, 0.103)
           WHEN 'Pb-Pb' THEN 600 * pow(sqrts / 5020, 0.103) / 5.3
           WHEN 'Xe-Xe' THEN 1.0 ELSE 16.3 * pow(sqrts / 5020, 0.103) / 5.3 END) AS scale
       FROM q""",
)
def beam_energy_scale(spark, sf):
    name = F.element_at(F.array(*[F.lit(b) for b in _BEAMS]), (C("s_nationkey") % 5 + 1).cast("int"))
    df = base(spark, sf, "supplier").select(
        C("s_suppkey").alias("run"), name.alias("beam"), (3000 + C("s_acctbal") / 4).alias("energy")
    )
    sqrts, scale = calibration.beam_scale(C("beam"), C("energy"))
    return df.select("run", "beam", r6(sqrts).alias("sqrts"), r6(scale).alias("scale"))


@query(
    "b26_resource_log_deltas",
    """WITH s AS (SELECT ts_us / 1e6 AS stamp, user_id, event_id, value FROM
         (SELECT date_diff('microsecond', TIMESTAMP '2024-01-01 00:00:00', ts) AS ts_us, * FROM events) q),
       l AS (SELECT *, lag(stamp) OVER w AS old_stamp, lag(value) OVER w AS old_value,
           first_value(stamp) OVER w AS first_stamp
         FROM s WINDOW w AS (PARTITION BY user_id ORDER BY stamp, event_id))
       SELECT user_id, event_id, r6(stamp - old_stamp) AS delta_t, r6(value - old_value) AS delta_vm FROM l""",
)
def resource_log_deltas(spark, sf):
    df = table(spark, sf, "readings").drop("sensor").join(
        base(spark, sf, "events").select(C("event_id").alias("rec"), "user_id"), "rec"
    )
    df = blocked(
        df,
        ["user_id"],
        F.floor(C("t") / 3600),
        ["t", "rec"],
        lag={"old_t": C("t"), "old_value": C("reading")},
    )
    return df.select(
        "user_id",
        C("rec").alias("event_id"),
        r6(C("t") - C("old_t")).alias("delta_t"),
        r6(C("reading") - C("old_value")).alias("delta_vm"),
    )
