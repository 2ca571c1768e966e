"""Two-sided comparison of keyed datasets: first difference per key, extras, spare rules, summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyloom.functions import keys as K
from keyloom.operators.modules import disposition

MISSING, EXTRA = "missing_on_target", "extra_on_target"


def ttl_differs(src: Column, tgt: Column, tolerance_ms: int) -> Column:
    """Only one side expires, or both do and their remaining times differ by more than the tolerance."""
    s, t = F.coalesce(src, F.lit(-1)) > 0, F.coalesce(tgt, F.lit(-1)) > 0
    return (s != t) | (s & t & (F.abs(src - tgt) > tolerance_ms))


def compare(
    src: DataFrame, tgt: DataFrame, names: K.KeyNames = K.KeyNames(), deny: list[str] = (), only: list[str] = (), types: list[str] = (),
    ttl_strategy: str = "PRESERVE", ttl_offset_ms: int = 0, tolerance_ms: int = 5000, compare_values: bool = True, spare: Column | None = None,
) -> DataFrame:
    """(key, reason, checked, not_restored) for every key in scope of either side, in one full outer join on the target's name.

    Both sides carry key, type, ttl_ms, size and value (a digest will do); a true ``unreadable`` on either
    side is a reason of its own where values would be compared. Source keys without a target name are left
    out: the writer reports them. Keys of types that are not asked for, or that no target holds, are skipped
    and no difference. A key that could only be restored and is not there is not_restored, not a
    difference. All others of the source are checked; the first failing test names the reason: missing, type,
    ttl (against what the strategy gives), then size and value, which only core types have. Target keys that
    come from a source name in scope which is gone are extra, unless ``spare``, a predicate over the target's
    columns, accepts them.
    """
    flag = lambda df: (F.coalesce(F.col("unreadable"), F.lit(False)) if "unreadable" in df.columns else F.lit(False))
    cols = ("type", "ttl_ms", "size", "value")
    s = src.filter(K.allows_key(F.col("key"), deny, only)).withColumn("_name", names.to_target(F.col("key"))).filter("_name is not null")
    s = s.select("_name", F.col("key").alias("s_key"), *(F.col(c).alias(f"s_{c}") for c in cols), flag(src).alias("s_bad"), F.lit(True).alias("in_src"))
    t = tgt.withColumn("_source", names.to_source(F.col("key"))).filter(F.col("_source").isNotNull() & K.allows_key(F.col("_source"), deny, only))
    t = t.select(
        F.col("key").alias("_name"), "_source", *(F.col(c).alias(f"t_{c}") for c in cols), flag(tgt).alias("t_bad"), F.lit(True).alias("in_tgt"),
        (F.coalesce(spare, F.lit(False)) if spare is not None else F.lit(False)).alias("spared"),
    )
    kind = F.col("s_type")
    core, known = kind.isin(*K.CORE_TYPES), F.coalesce(disposition(kind), F.lit(""))
    skipped = ~F.coalesce(K.allows_type(kind, list(types)), F.lit(True)) | (~core & (known == "not_supported"))
    skipped = F.col("in_src").isNotNull() & F.coalesce(skipped, F.lit(False))
    lost = ~skipped & F.col("in_src").isNotNull() & F.col("in_tgt").isNull() & F.coalesce(~core & (known == "restore_only"), F.lit(False))
    reason = (
        F.when(skipped | lost, None)
        .when(F.col("in_tgt").isNull(), MISSING)
        .when(F.col("in_src").isNull() & F.col("spared"), None)
        .when(F.col("in_src").isNull(), EXTRA)
        .when(~kind.eqNullSafe(F.col("t_type")), "type")
        .when(ttl_differs(K.effective_ttl(F.col("s_ttl_ms"), ttl_strategy, ttl_offset_ms), F.col("t_ttl_ms"), tolerance_ms), "ttl")
        .when(~F.coalesce(core, F.lit(True)), None)
        .when(~F.col("s_size").eqNullSafe(F.col("t_size")), "size")
    )
    if compare_values:
        reason = reason.when(F.col("s_bad") | F.col("t_bad"), "unreadable").when(~F.col("s_value").eqNullSafe(F.col("t_value")), "value")
    met = s.join(t, "_name", "full_outer")
    return met.select(F.coalesce("s_key", "_source").alias("key"), reason.alias("reason"), (F.col("in_src").isNotNull() & ~skipped & ~lost).alias("checked"), lost.alias("not_restored"))


def pass_totals(compared: DataFrame) -> DataFrame:
    """One row (keys_checked, differences, not_restored) of a comparison."""
    return compared.agg(F.count_if("checked").alias("keys_checked"), F.count("reason").alias("differences"), F.count_if("not_restored").alias("not_restored"))


def first_differences(
    src: DataFrame, tgt: DataFrame, tolerance_ms: int = 5000, compare_values: bool = True, spare: Column | None = None, **how
) -> DataFrame:
    """(key, reason) for every key that the sides do not agree on, as ``compare`` finds them."""
    found = compare(src, tgt, tolerance_ms=tolerance_ms, compare_values=compare_values, spare=spare, **how)
    return found.filter("reason is not null").select("key", "reason")


def pass_summary(diffs: DataFrame) -> DataFrame:
    return diffs.groupBy("reason").agg(F.count("*").alias("n"))


def examples(diffs: DataFrame, n: int = 100) -> DataFrame:
    """The first n differences by key."""
    return diffs.orderBy("key", "reason").limit(n)
