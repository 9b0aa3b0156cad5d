"""Parameterised metric families.

Each family is ``f(frames..., **params) -> DataFrame`` composed from the
operators; the registered catalog binds them to the stand-in feeds.
"""
from __future__ import annotations

from pyspark.sql import DataFrame

from strata.operators.aggregates import sum_by
from strata.operators.projection import round_all, with_row_id
from strata.operators.timeseries import rolling_mean


def rolling_total(df: DataFrame, period: str, measure: str, window: int = 12, dp: int = 0,
                  avg_name: str = "rolling_avg", row_id: str | None = "Unique_ID") -> DataFrame:
    """Total per period, trailing ``window``-period mean, rounded, keyed."""
    per = sum_by(df, [period], [measure])
    out = round_all(rolling_mean(per, [period], measure, window, name=avg_name), dp)
    return with_row_id(out, [period], name=row_id) if row_id else out


# ---------------------------------------------------------------- usage
from collections.abc import Mapping, Sequence  # noqa: E402

from pyspark.sql import Column  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from strata.functions import columns as C  # noqa: E402
from strata.operators import aggregates as A  # noqa: E402
from strata.operators import filters as FL  # noqa: E402
from strata.operators import joins as J  # noqa: E402
from strata.operators import timeseries as W  # noqa: E402
from strata.operators.projection import rename  # noqa: E402


def daily_measure(df: DataFrame, measure: str, date: str = "Date", org: str = "OdsCode",
                  org_name: str = "Practice_code", row_id: str | None = "Unique_ID") -> DataFrame:
    """Coerce one text measure, sum per (date, org), surrogate key."""
    x = df.select(date, org, C.coerce(measure).alias(measure))
    out = rename(A.sum_by(x, [date, org], [measure]), {org: org_name})
    return with_row_id(out, [date, org_name], name=row_id) if row_id else out


def cum_by_org(df: DataFrame, measure: str, date: str = "Date", org: str = "OdsCode", name: str = "Cumulative") -> DataFrame:
    """Per-org cumulative sum of a coerced measure."""
    x = df.select(date, org, C.coerce(measure).alias(measure))
    return W.cumsum_by(x, org, date, measure, name=name)


def dense_cum(df: DataFrame, measure: str, date: str = "Date", org: str = "OdsCode", name: str = "Cumulative") -> DataFrame:
    """Dense per-org cumulative series (every day from first observation)."""
    x = df.select(date, org, C.coerce(measure).alias(measure))
    return W.dense_cumsum(x, org, date, measure, name=name)


def uptake_scaffold(usage: DataFrame, pop: DataFrame, measure: str, min_age: int = 12, date: str = "Date",
                    org: str = "OdsCode", pop_org: str = "GP_Practice_Code", age: str = "AGE", size: str = "Size",
                    snap: str = "Effective_Snapshot_Date") -> DataFrame:
    """Cumulative registrations per practice and day against the
    registered population on a (date x practice) scaffold."""
    cum = cum_by_org(usage, measure, date, org, name="Cumulative").drop(measure).withColumnRenamed(org, "Practice")
    ref = FL.adult_population(pop, age, min_age).groupBy(F.col(pop_org).alias("Practice")).agg(
        F.sum(size).cast("long").alias("Population"), F.max(snap).alias("Snapshot"))
    dates = cum.select(date).distinct()
    lo, hi = dates.select(F.min(date)).scalar(), dates.select(F.max(date)).scalar()
    grid = J.scaffold(ref, lo, hi, "1 day", date).join(dates, date, "left_semi")
    return J.scaffold_fill(cum, grid, [date, "Practice"], ["Cumulative", "Population"], {"Snapshot": "Snapshot"})


def weekly_pct(usage: DataFrame, pop: DataFrame, measure: str, min_age: int = 17, date: str = "Date",
               age: str = "AGE", size: str = "Size", snap: str = "Effective_Snapshot_Date", dp: int = 4) -> DataFrame:
    """Weekly (Sunday) totals, cumulative users, share of the latest
    adult population snapshot."""
    x = usage.select(date, C.coerce(measure).alias(measure))
    wk = W.resample(x, date, [measure], "W", name="Week_Ending")
    cum = W.cumsum(wk, ["Week_Ending"], [measure], names={measure: "Users"}).drop(measure)
    adults = FL.adult_population(FL.latest_rows(pop, snap), age, min_age)
    out = J.with_scalar(cum, "Adult_Population", adults.select(F.sum(size).cast("long")))
    return out.withColumn("Share", C.ratio("Users", "Adult_Population", dp))


def clicks(df: DataFrame, providers: Sequence[str], services: Sequence[str], cutoff: str | None = None,
           apply_cutoff: bool = True, keys: Sequence[str] = ("Provider", "Date", "OdsCode")) -> DataFrame:
    """Clicks for a (provider, service) selection summed per keys, from
    a cut-off date (``apply_cutoff=False`` keeps the uncut frame)."""
    x = df.filter(F.col("Provider").isin(list(providers)) & F.col("JumpOff").isin(list(services)))
    out = A.sum_by(x, list(keys), ["Clicks"])
    return FL.on_or_after(out, "Date", cutoff) if (cutoff and apply_cutoff) else out


def clicks_dynamic(df: DataFrame) -> DataFrame:
    """Drop the legacy ``Cie`` suffix, sum, sentence-case the service,
    month buckets labelled by month end (the last by the true last date)."""
    x = df.withColumn("Provider", C.regex_replace("Provider", "Cie", ""))
    x = A.sum_by(x, ["Date", "OdsCode", "Provider", "JumpOff"], ["Clicks"])
    x = x.withColumn("Service", C.sentence_case("JumpOff")).drop("JumpOff")
    return W.month_bucket_truncated_last(x, "Date", ["OdsCode", "Provider", "Service"], ["Clicks"], name="Date")


def typed_passthrough(df: DataFrame, mapping: Mapping[str, str], types: Mapping[str, str]) -> DataFrame:
    """Rename and cast columns of an already-shaped feed."""
    out = rename(df, mapping)
    return out.select(*[F.col(c).cast(types[c]).alias(c) if c in types else F.col(c) for c in out.columns])


# ---------------------------------------------------------------- channels
def month_rollup(df: DataFrame, date: str, measures: Sequence[str], name: str = "Month") -> DataFrame:
    """Month roll-up of one or more measures (pandas: all-null -> 0)."""
    return A.monthly_sum(df, date, list(measures), name=name)


def month_combined(df: DataFrame, date: str, parts: Sequence[str], total: str = "Total", strict: str | None = None) -> DataFrame:
    """Roll several measures up by month, then a null-skipping total
    and (optionally) a null-propagating sum of the first two."""
    m = A.monthly_sum(df, date, list(parts), null_sum=None)
    m = m.withColumn(total, C.row_sum(parts))
    return m.withColumn(strict, C.add(parts[:2])) if strict else m


def month_project(df: DataFrame, keep: Sequence[str], rename_map: Mapping[str, str], fill_cols: Sequence[str]) -> DataFrame:
    """Projection of a monthly table with renames and null -> 0."""
    out = rename(df.select(*keep), rename_map)
    return out.na.fill(0, subset=list(fill_cols))


def month_ratio(df: DataFrame, date: str, num: str, den: str, name: str = "Ratio", dp: int = 4) -> DataFrame:
    """Month roll-up of two measures and their ratio."""
    m = A.monthly_sum(df, date, [num, den])
    return m.withColumn(name, C.ratio(num, den, dp))


def channel_shift(app: DataFrame, allch: DataFrame, app_date: str, app_measure: str, all_date: str,
                  all_measure: str, dp: int = 4) -> DataFrame:
    """App measure (month roll-up) vs all-channel measure (month-end
    resample), inner-joined by month: offline residual and app share."""
    a = A.monthly_sum(app, app_date, [app_measure]).withColumnRenamed(app_measure, "App")
    t = W.resample(allch, all_date, [all_measure], "ME", name="Month_End").withColumn(
        "Month", F.date_format("Month_End", "yyyy-MM")).drop("Month_End").withColumnRenamed(all_measure, "All")
    j = J.join_on(a, t, "Month", how="inner")
    j = j.withColumn("Offline", C.residual("All", "App"))
    return j.withColumn("App_Share", F.bround(C.inf_to_zero("App", "All"), dp))


def month_start_pct(df: DataFrame, date: str, measure: str, population: float, dp: int = 4) -> DataFrame:
    """Month-start resample and share of a fixed population."""
    m = W.resample(df, date, [measure], "MS", name="Month")
    return m.withColumn("Population", F.lit(population)).withColumn("Share", C.ratio(measure, "Population", dp))


def actuals(frames: Sequence[DataFrame], key: str = "Month", drop_rx: str = r"^unnamed|deprecated") -> DataFrame:
    """Outer-merge monthly tables, drop deprecated/unnamed columns."""
    from strata.operators.projection import drop_matching

    return drop_matching(J.outer_merge_all(list(frames), key), drop_rx)


def messages(df: DataFrame, excluded: Sequence[str], categories: Sequence[str]) -> DataFrame:
    """Messages sent and read by notification type (read > 0 only)."""
    x = FL.isin(df, "Supplier", list(excluded), negate=True).filter(F.col("Read_By") > 0)
    x = x.withColumn("Push_Notification", C.fill("Push_Notification", "Unknown"))
    return A.pivot_multi(x, ["Date"], "Push_Notification", ["Count", "Read_By"], list(categories))


def notifications_only(df: DataFrame, excluded: Sequence[str]) -> DataFrame:
    """Volume of notifications nobody read."""
    x = FL.isin(df, "Supplier", list(excluded), negate=True).filter(F.col("Read_By") == 0)
    return A.sum_by(x, ["Date"], ["Count"])


# ---------------------------------------------------------------- practice feeds
def utilisation(df: DataFrame, keep: Sequence[str], pct_col: str, name: str = "Utilisation", dp: int = 4) -> DataFrame:
    """Percent text -> fraction, rounded."""
    return df.select(*keep, F.bround(C.percent(pct_col), dp).alias(name))


def compliance(df: DataFrame, key: str, answer: str, name: str = "Compliant", dp: int = 4) -> DataFrame:
    """YES/NO -> 1/0, compliant count, practices and share per key."""
    x = df.withColumn("_flag", C.yesno(answer))
    out = A.agg_by(x, [key], [("sum", "_flag", name), ("size", key, "Practices")])
    return out.withColumn(f"{name}_Share", C.ratio(name, "Practices", dp))


def latest_extract(df: DataFrame, ref: DataFrame, date: str, key: str, ref_key: str, ref_cols: Sequence[str]) -> DataFrame:
    """Last extract day of each month, joined to a reference table."""
    latest = FL.latest_per_month(df, date)
    return J.join_on(latest, ref.select(ref_key, *ref_cols), key, ref_key, "left").drop(ref_key)


def survey(df: DataFrame, keys: Sequence[str], num: str, den: str, other: str, dp: int = 4) -> DataFrame:
    """Survey proportions; negative sentinels are missing values."""
    x = df.select(*keys, C.null_if_negative(num).alias(num), C.null_if_negative(den).alias(den), C.null_if_negative(other).alias(other))
    x = x.withColumn("Prop", C.ratio(num, den, dp))
    return x.withColumn("Remainder", C.residual(den, num))


def rolling_rate(df: DataFrame, period: str, num: str, den: str, window: int = 12, per: float = 1000.0, dp: int = 2) -> DataFrame:
    """Rate per ``per`` population and its trailing mean."""
    agg = A.agg_by(df, [period], [("sum", num, num), ("sum", den, den)])
    agg = agg.withColumn("Rate", C.rate(num, den, per))
    return round_all(rolling_mean(agg, [period], "Rate", window, name="Rolling_Rate"), dp)


def valid_rows(df: DataFrame, flag: str, supplier: str, run_date: str) -> DataFrame:
    """Valid practices only, supplier cleaned, run date stamped."""
    from strata.operators.projection import with_literal

    x = df.filter(F.col(flag) == 1)
    x = x.withColumn(supplier, C.regex_replace(C.fill(supplier, "Unknown"), r"^\d+", "UNKNOWN"))
    return with_literal(x, "Run_Date", F.lit(run_date).cast("date"))


def field_flag(df: DataFrame, field: str, value: str, target, name: str = "Enabled", drop: Sequence[str] = ()) -> DataFrame:
    """Rows of one Field, numeric value compared with a target -> 1/0."""
    x = df.filter(F.col("Field") == field).withColumn(value, C.coerce(value))
    return x.withColumn(name, C.eq_flag(value, target)).drop(*drop)


def field_passthrough(df: DataFrame, field: str, drop: Sequence[str], mapping: Mapping[str, str]) -> DataFrame:
    """Rows of one Field, columns dropped and renamed."""
    return rename(df.filter(F.col("Field") == field).drop(*drop), mapping)


def national_sma(df: DataFrame, period: str, field: str, value: str, n: int = 3) -> DataFrame:
    """National total per period and its floored n-period mean."""
    x = A.sum_by(df.filter(F.col("Field") == field), [period], [value])
    r = rolling_mean(x, [period], value, n, name="_r")
    return r.withColumn("SMA", C.floor_fill("_r")).drop("_r")


def enabled_pct(df: DataFrame, keys: Sequence[str], num_field: str, den_field: str, dp: int = 4, sanity: bool = False) -> DataFrame:
    """numerator/denominator fields per keys and their ratio;
    ``sanity`` drops impossible ratios (> 1) but keeps missing ones."""
    nd = J.num_den(df, list(keys), "Field", "Value", num_field, den_field)
    nd = nd.withColumn("Pct", C.ratio("Numerator", "Denominator", dp))
    return FL.not_gt_keep_null(nd, "Pct", 1) if sanity else nd


# ---------------------------------------------------------------- message acknowledgements
ACK = "ACK"


def ack_pairs(acks: DataFrame, keys: Sequence[str], time: str = "_time") -> DataFrame:
    """Acknowledgement pairs per keys: count per (keys, sender, recipient),
    floor(n/2), summed per keys (A8)."""
    x = FL.contains(acks, "workflow", ACK).withColumn("Month", F.date_format(time, "yyyy-MM"))
    return A.paired_ack_count(x, [*keys, "senderOdsCode", "recipientOdsCode"], list(keys), name="Pairs")


def ack_pivot(acks: DataFrame, categories: Sequence[str], run_date: str) -> DataFrame:
    """National monthly pairs pivoted by workflow, with a column for each of ``categories`` and for every other
    acknowledgement workflow that occurs; incomplete run month dropped."""
    p = ack_pairs(acks, ["Month", "workflow"])
    wide = A.pivot_sum(p, ["Month"], "workflow", "Pairs", A.categories_of(FL.contains(acks, "workflow", ACK), "workflow", categories))
    return FL.drop_incomplete(wide, "Month", run_date=run_date)


def ack_trust(acks: DataFrame, categories: Sequence[str], run_date: str) -> DataFrame:
    """Per receiving trust (3-character code): pairs per site first,
    then the site codes are cut to the trust code and re-summed (T13). Columns as in ``ack_pivot``."""
    x = FL.contains(acks, "workflow", ACK).withColumn("Month", F.date_format("_time", "yyyy-MM"))
    site = A.count_by(x, ["Month", "workflow", "recipientOdsCode"], name="n").withColumn("Pairs", F.floor(F.col("n") / 2).cast("long"))
    site = site.withColumn("Trust", C.prefix("recipientOdsCode", 3))
    wide = A.pivot_sum(site, ["Month", "Trust"], "workflow", "Pairs", A.categories_of(x, "workflow", categories))
    return FL.drop_incomplete(wide, "Month", run_date=run_date)


def utilisation_positional(acks: DataFrame, denom: DataFrame, workflow: str, den_date: str, den_measure: str, dp: int = 2) -> DataFrame:
    """Monthly discharges matched to monthly message pairs by position
    (as the reference does), rate per 1 000 discharges."""
    d = A.monthly_sum(denom, den_date, [den_measure])
    p = ack_pairs(acks.filter(F.col("workflow") == workflow), ["Month"]).withColumnRenamed("Month", "Ack_Month")
    z = J.zip_join(d, p, ["Month"], ["Ack_Month"]).drop("Ack_Month")
    return z.withColumn("Per_1000", F.bround(C.rate("Pairs", den_measure, 1000), dp))


def trust_rate(acks: DataFrame, denom: DataFrame, workflow: str, den_date: str, den_org: str, den_measure: str,
               grain: str = "month", drop_last: bool = False, run_date: str | None = None, dp: int = 2) -> DataFrame:
    """Pairs per 1 000 discharges. Pairs are floor(n / 2) per (period,
    recipient site), whoever sent them; site and provider codes are then cut
    to the trust's three characters, and every site keeps its row beside its
    trust's discharges. ``grain='day'`` joins day by day, leaves out
    denominators dated ``run_date`` or later, and sums to months (M35)."""
    x = FL.contains(acks.filter(F.col("workflow") == workflow), "workflow", ACK)
    day = grain == "day"
    period = F.to_date if day else (lambda c: F.date_format(c, "yyyy-MM"))
    name = "Day" if day else "Month"
    site = A.count_by(x.withColumn(name, period(F.col("_time"))), [name, "recipientOdsCode"], name="n")
    site = site.select(name, C.prefix("recipientOdsCode", 3).alias("Trust"), F.floor(F.col("n") / 2).cast("long").alias("Pairs"))
    den = denom.withColumn(name, period(F.col(den_date)))
    den = den.withColumn("Trust", F.col(den_org) if day else C.prefix(den_org, 3))
    den = A.sum_by(den, [name, "Trust"], [den_measure])
    if run_date:
        den = den.filter(F.col(name) < F.lit(run_date).cast("date"))
    out = J.join_on(den, site, [name, "Trust"], how="left").na.fill(0, subset=["Pairs"])
    if day:
        out = A.sum_by(out.withColumn("Month", F.date_format("Day", "yyyy-MM")), ["Month", "Trust"], [den_measure, "Pairs"])
    if drop_last:
        out = FL.drop_incomplete(out, "Month", mode="max")
    return out.withColumn("Per_1000", F.bround(C.rate("Pairs", den_measure, 1000), dp))


def trust_suppressed(acks: DataFrame, mh: DataFrame, workflow: str, dp: int = 2) -> DataFrame:
    """Discharges per (month, trust), suppressed cells imputed from the national total less all provider numbers, shared
    out over all suppressed cells. Every recipient site keeps its own row of pairs beside its trust's discharges."""
    prov = A.impute_suppressed(mh.filter(F.col("Breakdown") == "Provider"), "Measure_Value_Str", *A.suppressed_share(
        mh, "Measure_Value", "Measure_Value_Str", F.col("Breakdown") == "England", F.col("Breakdown") == "Provider"), name="Discharges")
    prov = prov.withColumn("Month", F.date_format("Reporting_Period_Start", "yyyy-MM")).withColumnRenamed("Primary_Level", "Trust")
    den = A.sum_by(prov, ["Month", "Trust"], ["Discharges"])
    x = acks.filter(F.col("workflow") == workflow).withColumn("Month", F.date_format("_time", "yyyy-MM"))
    site = A.count_by(x, ["Month", "recipientOdsCode"], name="n").select(
        "Month", C.prefix("recipientOdsCode", 3).alias("Trust"), F.floor(F.col("n") / 2).cast("long").alias("Pairs"))
    j = J.join_on(den, site, ["Month", "Trust"], how="left").na.fill(0, subset=["Pairs"])
    return j.withColumn("Per_1000", F.bround(C.rate("Pairs", "Discharges", 1000), dp)).withColumn("Discharges", F.bround("Discharges", dp))


# ---------------------------------------------------------------- status and responses
def status_mix(df: DataFrame, date: str, area: str, status: str, published: str | None, statuses: Sequence[str], outdated: int = 0, switch: str | None = None) -> DataFrame:
    """Rows per (date, area, status) with the area's total over the statuses that count; rows without an area
    fall out. From the date whose newest ``published`` is behind ``switch`` on, the first ``outdated`` statuses don't count."""
    kept = FL.isin(df.filter(F.col(area).isNotNull()), status, list(statuses))
    if switch:
        newest = df.groupBy(date).agg(F.max(published).alias("_newest"))
        old = F.col(status).isin(list(statuses[:outdated])) & F.coalesce(F.col("_newest") > F.lit(switch).cast("date"), F.lit(False))
        kept = J.join_on(kept, newest, date, how="left").filter(~old)
    n = A.count_by(kept, [date, area, status], name="n")
    return J.join_on(n, A.sum_by(n, [date, area], ["n"], names={"n": "total"}), [date, area], how="left")


def met_by_date(df: DataFrame, date: str, status: str, buckets, dp: int = 4) -> DataFrame:
    """One row per date: rows whose status counts as met in the date's bucket, all rows, and their share. Dates without
    a met row are left out."""
    n = A.count_by(df.filter(F.col(status).isNotNull()), [date, status], name="n")
    met = A.sum_by(FL.bucketed_status(n, date, status, buckets), [date], ["n"], names={"n": "Met_Or_Exceeded"})
    total = A.sum_by(n, [date], ["n"], names={"n": "Total"})
    return J.join_on(met, total, date, how="left").withColumn("Pct", C.ratio("Met_Or_Exceeded", "Total", dp))


def responses_by_month(answers: DataFrame, places: DataFrame, entity: str, place_key: str, date: str, keys: Sequence[str], dims: Sequence[str], answer: str) -> DataFrame:
    """Every response counts by month, ``keys`` and the place's ``dims``; rows with a null among them fall out. The share
    is of the yes and no answers."""
    j = J.join_on(answers.withColumn("Month_Year", F.date_format(date, "MM-yyyy")), places, entity, place_key, how="left")
    grouped = [*keys, *dims]
    j = j.dropna(subset=["Month_Year", *grouped])
    out = j.groupBy("Month_Year", *grouped).agg(
        F.count_if(F.col(answer) == "Yes").alias("PIR_YES"), F.count_if(F.col(answer) == "No").alias("PIR_NO"), F.count(answer).alias("PIR_COUNT"))
    return out.withColumn("PIR_PERCENTAGE", F.try_divide(F.col("PIR_YES").cast("double"), (F.col("PIR_YES") + F.col("PIR_NO")).cast("double")))


# ---------------------------------------------------------------- wards
def stp_population(pop: DataFrame, extract: str, org_type: str, org: str, sex: str, age: str, size: str, min_age: int = 16) -> DataFrame:
    """Registered population per (extract date, organisation): STP rows of both
    sexes, all-age rows left out, ``min_age`` and over."""
    x = pop.filter((F.col(org_type) == "STP") & F.col(sex).isin("FEMALE", "MALE"))
    return A.sum_by(FL.adult_population(x, age, min_age - 1), [extract, org], [size])


def per_100k(facts: DataFrame, pop: DataFrame, date: str, org: str, measure: str, cutoff: str | None,
             extract: str, size: str, require: bool = False, dp: int = 2) -> DataFrame:
    """Measure per (date, org) from the cut-off on, full outer join to
    the population of every extract of the org, per 100 000."""
    x = FL.nulls(facts, measure, keep_null=False) if require else facts
    m = A.sum_by(FL.on_or_after(x, date, cutoff) if cutoff else x, [date, org], [measure])
    j = J.full_join(m, pop, org).drop(extract)
    return j.withColumn("Per_100k", F.bround(C.rate(measure, size, 100000), dp))


def fiscal_per_100k(facts: DataFrame, pop: DataFrame, date: str, org: str, measure: str, cutoff: str,
                    extract: str, size: str, dp: int = 2) -> DataFrame:
    """Measure per (date, org), full outer join to the population extract
    whose year's April opens the fiscal year of the date, per 100 000. Dates
    of fiscal years without an extract are left out, as the reference's loop over extracts does."""
    x = FL.on_or_after(FL.nulls(facts, measure, keep_null=False), date, cutoff)
    m = A.sum_by(x, [date, org], [measure]).withColumn("FY", C.fin_year_start(date))
    extracts = pop.select(F.year(extract).alias("FY"), F.col(extract)).distinct()
    m = m.join(extracts, "FY")
    j = J.full_join(m, pop.withColumn("FY", F.year(extract)), ["FY", extract, org]).drop(extract)
    return j.withColumn("Per_100k", F.bround(C.rate(measure, size, 100000), dp))
