"""Synthetic columns R1-R10 (bids, campaign targets, clicks).

Default ``mode="keyed"`` draws from :class:`Draws` (repeatable under retries
and re-partitioning); ``mode="native"`` uses Spark's ``rand``/``randn`` like
the reference (not repeatable).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adpulse.functions.keyed_random import Draws, choice
from adpulse.functions.scalars import ceil_step, clamp

# Fixed values of the reference's generators.
BID_MEAN, BID_SD, BID_MIN, BID_MAX, BID_STEP = 3.25, 1.0, 0.25, 6.25, 0.25
CPA_FACTOR_MEAN, CPA_FACTOR_SD = 30.0, 3.0
BUDGET_CHOICES = [5000, 6250, 7500, 8750, 10000, 11250, 12500, 15000]
MARGIN_CHOICES = [0.3, 0.35, 0.4, 0.45]
CLICKS_MIN, CLICKS_MAX = 10, 80
COST_SD = 0.5
APPLICANT_P_MEAN, APPLICANT_P_SD = 0.15, 0.03
DEVICE_TYPES = ("Mobile", "PC")
GENDERS = ("Male", "Female")
AGE_GROUPS = ["18-25", "25-32", "32-40", "40-50", "50-60", "60-99"]


def _normal(df: DataFrame, mode: str, salt: str, keys, seed):
    if mode == "native":
        return df, F.randn(seed), None
    d = Draws(salt, keys, normals=1)
    return d.attach(df), d.normal(0), d


def add_bid(df: DataFrame, key="id", mean=BID_MEAN, sd=BID_SD, lo=BID_MIN, hi=BID_MAX,
            step=BID_STEP, mode="keyed", salt="bid", seed=None) -> DataFrame:
    """bid = ceil(clamp(N(mean, sd), lo, hi) / step) * step."""
    df, z, d = _normal(df, mode, salt, [key], seed)
    raw = F.lit(mean) + F.lit(sd) * z
    df = df.withColumn("bid", ceil_step(clamp(raw, lo, hi), step))
    return d.detach(df) if d else df


def add_cpa_target(df: DataFrame, key_cols=("company_name", "state"), avg_col="avg_bid",
                   mode="keyed", salt="cpa", seed=None) -> DataFrame:
    """R2: cpa_target = int(avg_bid * N(30, 3)), truncated toward zero."""
    df, z, d = _normal(df, mode, salt, list(key_cols), seed)
    factor = z * F.lit(CPA_FACTOR_SD) + F.lit(CPA_FACTOR_MEAN)
    df = df.withColumn("cpa_target", (F.col(avg_col) * factor).cast("int"))
    return d.detach(df) if d else df


def add_budget_margin(df: DataFrame, key_cols=("company_name", "state"), mode="keyed",
                      salt="plan", seed=None, budgets=BUDGET_CHOICES,
                      margins=MARGIN_CHOICES) -> DataFrame:
    """Budget and margin, each a uniform pick from its list."""
    if mode == "native":
        u1, u2, d = F.rand(seed), F.rand(None if seed is None else seed + 1), None
    else:
        d = Draws(salt, list(key_cols), uniforms=2)
        df = d.attach(df)
        u1, u2 = d.uniform(0), d.uniform(1)
    df = df.withColumns({"budget": choice(u1, budgets).cast("int"),
                         "margin": choice(u2, margins).cast("double")})
    return d.detach(df) if d else df


def click_count(u: Column, lo: int = CLICKS_MIN, hi: int = CLICKS_MAX) -> Column:
    """floor(u * (hi - lo + 1) + lo), i.e. lo..hi."""
    return F.floor(u * F.lit(float(hi - lo + 1)) + F.lit(float(lo))).cast("int")


def add_click_counts(df: DataFrame, keys=("job_id", "date"), mode="keyed", salt="nclicks",
                     seed=None, lo: int = CLICKS_MIN, hi: int = CLICKS_MAX) -> DataFrame:
    if mode == "native":
        return df.withColumn("num_clicks", click_count(F.rand(seed), lo, hi))
    d = Draws(salt, list(keys), uniforms=1)
    return d.detach(d.attach(df).withColumn("num_clicks", click_count(d.uniform(0), lo, hi)))


# '00'..'59': a constant array, so a field is a lookup, not a cast and a pad.
_TWO_DIGITS = [f"{v:02d}" for v in range(60)]


def _two_digits(u: Column, n: int) -> Column:
    idx = F.floor(u * F.lit(float(n))).cast("int") + F.lit(1)
    return F.element_at(F.array(*[F.lit(v) for v in _TWO_DIGITS[:n]]), idx)


def time_string(u_h: Column, u_m: Column, u_s: Column) -> Column:
    """Uniform HH:MM:SS."""
    return F.concat(_two_digits(u_h, 24), F.lit(":"), _two_digits(u_m, 60), F.lit(":"),
                    _two_digits(u_s, 60))


def click_id(job_id="job_id", date="date", idx="click_idx") -> Column:
    return F.concat_ws("_", F.col(job_id).cast("string"), F.col(date).cast("string"),
                       F.col(idx).cast("string"))


def click_draws(keys=("job_id", "date"), counter="click_idx", salt="click") -> Draws:
    """Draws of one click: seeds per job-day, the click number as counter."""
    return Draws(salt, list(keys), uniforms=7, normals=2, counter=counter)


def add_click_columns(df: DataFrame, mode="keyed", draws: Draws | None = None, seed=None,
                      cost_sd=COST_SD, p_mean=APPLICANT_P_MEAN, p_sd=APPLICANT_P_SD) -> DataFrame:
    """R6-R10 on click rows that carry ``bid`` (and, keyed, the seeds of
    ``draws`` attached to their job-day)."""
    if mode == "native":
        s = (lambda i: None) if seed is None else (lambda i: seed + i)
        u = [F.rand(s(i)) for i in range(7)]
        z = [F.randn(s(7)), F.randn(s(8))]
        d = None
    else:
        d = draws or click_draws()
        if d.seed_cols[0] not in df.columns:
            df = d.attach(df)
        u = [d.uniform(i) for i in range(7)]
        z = [d.normal(0), d.normal(1)]
    p = clamp(z[1] * F.lit(p_sd) + F.lit(p_mean), 0.0, 1.0)
    df = df.withColumns({
        "cost": F.col("bid") + F.lit(cost_sd) * z[0],
        "device_type": F.when(u[0] < 0.5, DEVICE_TYPES[0]).otherwise(DEVICE_TYPES[1]),
        "time": time_string(u[1], u[2], u[3]),
        "gender": F.when(u[4] < 0.5, GENDERS[0]).otherwise(GENDERS[1]),
        "age_group": choice(u[5], AGE_GROUPS),
        "is_applicant": F.when(u[6] < p, 1).otherwise(0),
    })
    return d.detach(df) if d else df
