"""Synthetic vulnerability tables.

The generator is seeded per key with a hash, so a row's values depend only on
(key, seed): reproducible, partition-independent and retry-safe, with no
driver-side random state.  Only distributions are meant to resemble the
reference's generator, not individual values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# FIXED VALUES: severity mix, score ranges, exploit factors and patch times
SEVERITY_WEIGHTS = [("Low", 0.15), ("Medium", 0.30), ("High", 0.40), ("Critical", 0.15)]
SEVERITY_RANGES = {"Low": (2.0, 3.9), "Medium": (4.0, 6.9), "High": (7.0, 8.9), "Critical": (9.0, 10.0)}
SEVERITY_EXPLOIT_MULT = {"Low": 0.5, "Medium": 0.8, "High": 1.2, "Critical": 1.5}
TIME_TO_PATCH = {"Low": (365, 450), "Medium": (270, 365), "High": (180, 270), "Critical": (150, 180)}
EXPLOIT_RATE = 0.07

# FIXED VALUES: industry sectors and their risk
INDUSTRIES = [("Power Generation", 5), ("Power Transmission", 5), ("Energy Distribution", 4), ("Water Treatment", 4),
              ("Oil and Gas", 5), ("Manufacturing", 3), ("Chemical Processing", 4), ("Transportation", 3),
              ("Building Automation", 2)]

# FIXED VALUES: integer columns drawn evenly from a range, both ends included
EVEN_COLUMNS = [("iiot_integration_level", 0, 3), ("legacy_system_dependency", 0, 4),
                ("component_interconnection_score", 1, 5), ("system_complexity", 1, 5),
                ("financial_impact_score", 1, 5), ("regulatory_impact_score", 0, 3),
                ("supply_chain_risk_score", 0, 4), ("attack_complexity", 1, 5),
                ("patch_implementation_complexity", 1, 5), ("system_recovery_time", 1, 168),
                ("patch_testing_impact", 0, 4), ("deployment_risk", 1, 5), ("detection_complexity_score", 1, 5),
                ("alert_generation_rate", 0, 100), ("response_time_required", 1, 24),
                ("geographic_impact_scope", 1, 4), ("operational_technology_impact", 0, 5),
                ("network_segmentation_level", 0, 3), ("access_control_level", 1, 4),
                ("attack_vector_complexity", 1, 5), ("attack_chain_length", 1, 10), ("required_access_level", 0, 3),
                ("authentication_requirements", 0, 3)]


def uniform(key: Column, seed: int, stream: int) -> Column:
    """U[0,1) from a seeded 64-bit hash of (key, stream)."""
    return F.pmod(F.xxhash64(key, F.lit(seed), F.lit(stream)), F.lit(1 << 30)) / float(1 << 30)


def randint(key: Column, seed: int, stream: int, lo: int, hi: int) -> Column:
    """Integer in [lo, hi] inclusive."""
    return (F.lit(lo) + F.floor(uniform(key, seed, stream) * (hi - lo + 1))).cast("int")


def clamp_int(x: Column, lo: int, hi: int) -> Column:
    """min(hi, max(lo, int(x))) with int() truncating toward zero."""
    return F.least(F.lit(hi), F.greatest(F.lit(lo), x.cast("int")))


def _by_severity(table: dict, part: int) -> Column:
    return F.coalesce(*[F.when(F.col("severity") == n, F.lit(v[part])) for n, v in table.items()])


def synth_generate(seed_rows: DataFrame, key: str, seed: int = 1945) -> DataFrame:
    """One generated vulnerability per row of ``seed_rows``."""
    k = F.col(key)
    streams = iter(range(1, 1000))

    def draw(lo: float = 0.0, hi: float = 1.0) -> Column:
        return F.lit(lo) + uniform(F.col("row_key"), seed, next(streams)) * (F.lit(hi) - F.lit(lo))

    def whole(lo: int, hi: int) -> Column:
        return randint(F.col("row_key"), seed, next(streams), lo, hi)

    df = seed_rows.select(k.alias("row_key"))
    acc, turn = 0.0, draw()
    severity = F
    for name, weight in SEVERITY_WEIGHTS:
        acc += weight
        severity = severity.when(turn < acc, F.lit(name))
    df = df.withColumn("severity", severity.otherwise(F.lit(SEVERITY_WEIGHTS[-1][0])))
    lo, hi = _by_severity(SEVERITY_RANGES, 0), _by_severity(SEVERITY_RANGES, 1)
    df = df.withColumn("cvss_score", F.round(lo + draw() * (hi - lo), 1))
    tenth = F.col("cvss_score") / 10
    factor = F.coalesce(*[F.when(F.col("severity") == n, F.lit(m)) for n, m in SEVERITY_EXPLOIT_MULT.items()])
    from_day, to_day = _by_severity(TIME_TO_PATCH, 0), _by_severity(TIME_TO_PATCH, 1)
    df = df.withColumns({
        "exploited": (draw() < tenth * tenth * factor * EXPLOIT_RATE).cast("int"),
        "device_criticality_adjusted": clamp_int(whole(1, 5) * 0.7 + tenth * 5 * 0.3, 1, 5),
        "time_to_patch_release": F.floor(from_day + draw() * (to_day - from_day)).cast("int"),
        "published_year": whole(2023, 2024),
        "_industry": whole(0, len(INDUSTRIES) - 1),
        **{name: whole(a, b) for name, a, b in EVEN_COLUMNS}})
    hit, level = F.col("exploited") == 1, F.col("device_criticality_adjusted")
    industry = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(r).alias("risk")) for n, r in INDUSTRIES])
    df = df.withColumns({
        "published_date": F.make_date("published_year", whole(1, 12), whole(1, 28)),
        "epss_score": F.round(F.when(hit, draw(0.3, 0.819)).otherwise(F.lit(0.01) + draw() * (tenth * 0.3 - 0.01)), 3),
        "exploitability_score": F.round(draw() * 10, 2),
        "operational_impact_score": clamp_int(level * 0.6 + tenth * 5 * 0.4, 0, 5),
        "physical_impact_potential": clamp_int(level * 0.7 + draw() * 0.3 * 4, 0, 4),
        "cascade_effect_score": clamp_int(level * 0.5 + F.col("system_complexity") * 0.5, 0, 5),
        "days_until_first_exploit": F.when(hit, whole(1, 180)).otherwise(F.lit(0)),
        "exploit_success_rate": F.round(F.when(hit, draw(0.3, 1.0)).otherwise(draw(0.0, 0.3)), 3),
        "nation_state_threat_level": clamp_int(level / 5 * 3 + draw() * 0.3 * 3, 0, 3),
        "mitigation_effectiveness": F.round(draw(), 3),
        "false_positive_rate": F.round(draw() * 0.5, 3),
        "industry_sector": industry[F.col("_industry")]["name"],
        "industry_sector_risk": industry[F.col("_industry")]["risk"],
        "cve_id": F.concat(F.lit("CVE-"), F.col("published_year").cast("string"), F.lit("-"),
                           (F.lit(1000) + F.col("row_key")).cast("string"))})
    return weighted_risk_score(df.drop("_industry", "published_year"), cvss="cvss_score")


def risk_components(li: DataFrame) -> DataFrame:
    """Component scores derived from lineitem columns (adapter for S17)."""
    cvss = F.col("l_quantity") / 5
    dca = clamp_int((F.col("l_linenumber") % 5 + 1) * 0.7 + cvss / 10 * 5 * 0.3, 1, 5)
    return li.select("l_orderkey", "l_linenumber", cvss.alias("cvss_score"),
                     dca.alias("device_criticality_adjusted"),
                     clamp_int(dca * 0.6 + cvss / 10 * 5 * 0.4, 0, 5).alias("operational_impact_score"),
                     (F.col("l_partkey") % 4).cast("int").alias("nation_state_threat_level"),
                     (F.col("l_suppkey") % 5 + 1).cast("int").alias("attack_complexity"),
                     (F.col("l_orderkey") % 5).cast("int").alias("supply_chain_risk_score"),
                     (F.col("l_partkey") % 5 + 1).cast("int").alias("system_complexity"),
                     (F.col("l_suppkey") % 4).cast("int").alias("iiot_integration_level"))


# FIXED VALUES: weights of the SECUREGRID score
SECUREGRID_WEIGHTS = [("device_criticality_adjusted", 10), ("operational_impact_score", 7),
                      ("nation_state_threat_level", 5), ("attack_complexity", 4),
                      ("supply_chain_risk_score", 3), ("system_complexity", 3),
                      ("iiot_integration_level", 2)]


def weighted_risk_score(df: DataFrame, cvss: str = "cvss_score") -> DataFrame:
    """Weighted sum of the components plus half the CVSS, rounded to 2."""
    total = F.lit(0.5) * F.col(cvss)
    for c, w in SECUREGRID_WEIGHTS:
        total = F.lit(w) * F.col(c) + total
    return df.withColumn("securegrid_score", F.round(total, 2))


def exploit_window_flags(df: DataFrame, days: str, cvss: str) -> DataFrame:
    """Exploited within 30/60/90 days (lag >= 0), zero-day (lag < 0),
    high CVSS (>= 7), as 0/1 integers."""
    d = F.col(days)
    return df.withColumns({
        "within_30": ((d >= 0) & (d <= 30)).cast("int"),
        "within_60": ((d >= 0) & (d <= 60)).cast("int"),
        "within_90": ((d >= 0) & (d <= 90)).cast("int"),
        "zero_day": (d < 0).cast("int"),
        "high_cvss": (F.col(cvss) >= 7).cast("int"),
    })
