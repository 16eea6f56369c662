"""Mixing sources to target weights by systematic sampling.

Every document of a source is expected ``target / source_size`` times. The documents of
a source stand in a fixed order by size, their expected copies are summed from the first
on, one offset per source is added, and a document is emitted once per whole number that
its stretch of the sum crosses. Sampling along the sizes keeps the words taken within a
few documents of the target.

The rank behind the prefix sum is found without ever sorting a source in one task:
counts of small bins (source, magnitude of size, part) are summed over the bins, and
only the rows of one bin are numbered together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm.common import materialize, named

#: Copies of a document at most, and so target over source size at most.
MOST = 3
#: Weights of the sources in order, repeated.
WEIGHTS = (1, 2, 3)
#: Rows numbered by one task at most, on average.
BIN_ROWS = 1_000
_WORDS = r"[^\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """Number of words of a text; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(_WORDS)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(source, source_size, target, offset) from rows of (source, size).

    Sources get weights in the order of their code points, null last. Targets share the
    whole size by weight; what exceeds ``most`` times a source goes to the others by
    weight. The result follows from exact sums, so it does not depend on row order. One
    row per source is all that is ever brought together.
    """
    exact = lambda c: c.cast("decimal(38,0)")
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(place) - 1) % len(weights)
    weighted = totals.withColumn("w", F.array(*map(F.lit, weights))[turn]).withColumn(
        "cap", F.lit(most) * F.col("source_size")
    )
    # Sources that reach their limit first come first; all before one are at theirs.
    order = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rest = order.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    full = weighted.withColumn(
        "full", exact(F.col("cap")) * exact(F.sum("w").over(rest)) < exact(left) * exact(F.col("w"))
    )
    kept = F.sum("source_size").over(everything) - F.sum(F.when(F.col("full"), F.col("cap")).otherwise(0)).over(everything)
    share = F.sum(F.when(F.col("full"), 0).otherwise(F.col("w"))).over(everything)
    target = F.when(F.col("full"), F.col("cap").cast("double")).otherwise(
        exact(kept * F.col("w")).cast("double") / share.cast("double")
    )
    mark = F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("n"))
    offset = F.conv(F.md5(mark.cast("binary")).substr(1, 13), 16, 10).cast("long") / F.lit(float(16**13))
    return full.select("source", "source_size", target.alias("target"), offset.alias("offset"))


def mix_plan(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source"
) -> DataFrame:
    """``doc_id``, ``source``, ``size``, ``source_size``, ``target``, ``copies`` and ``taken``.

    One row per row of ``docs``. Null texts have size 0, null sources are one source,
    null ids come first among equal sizes. A source without words has target 0 and takes
    nothing. Rows that agree in id, source and size may get different copies, but which
    of them does is of no consequence. Reruns agree: the offset comes from the source's
    name. Extra columns are not read.
    """
    sizes = materialize(
        docs.select(
            named(id_col).cast("long").alias("doc_id"),
            named(source_col).cast("string").alias("source"),
            words(named(text_col).cast("string")).alias("size"),
        ),
        "sizes",
    )
    targets = source_targets(sizes)
    magnitude = F.length(F.bin("size"))
    counts = (
        sizes.groupBy("source", magnitude.alias("magnitude"))
        .agg(F.count("*").alias("n"))
        .select("source", "magnitude", F.ceil(F.col("n") / BIN_ROWS).alias("parts"))
    )
    # ``source`` is made non-null here, so that joins on it stay plain equality joins.
    key = F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("n"))
    counts = counts.select(key.alias("key"), "magnitude", "parts")
    part = F.coalesce(F.pmod("doc_id", "parts"), F.lit(0))
    dealt = (
        sizes.withColumns({"key": key, "magnitude": magnitude})
        .join(counts, ["key", "magnitude"])
        .withColumn("part", part)
    )
    bins = dealt.groupBy("key", "magnitude", "part").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("key").orderBy("magnitude", "part").rowsBetween(Window.unboundedPreceding, -1)
    bins = bins.select("key", "magnitude", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    inside = Window.partitionBy("key", "magnitude", "part").orderBy("size", F.col("doc_id").asc_nulls_first())
    rank = F.col("before") + F.row_number().over(inside)
    ranked = dealt.join(bins, ["key", "magnitude", "part"]).select("key", "doc_id", "source", "size", rank.alias("rank"))
    rate = F.col("target") / F.nullif(F.col("source_size"), F.lit(0))
    step = lambda k: F.floor(rate * k + F.col("offset"))
    copies = F.coalesce(step(F.col("rank")) - step(F.col("rank") - 1), F.lit(0)).cast("long")
    return (
        ranked.join(targets.withColumn("key", key).drop("source"), "key")
        .withColumn("copies", copies)
        .select(
            "doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken")
        )
    )


def mix_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source"
) -> DataFrame:
    """``docs`` with every row as often as :func:`mix_plan` says; columns stay."""
    # ``_key`` tells apart what a plan row is found by; names that ``docs`` has are avoided.
    plan = mix_plan(docs, id_col, text_col, source_col).select(
        F.struct("doc_id", "source", "size").alias("_mix_key"), "copies"
    )
    order = Window.partitionBy("_mix_key").orderBy("_mix_order")
    plan = plan.withColumn("_mix_n", F.row_number().over(Window.partitionBy("_mix_key").orderBy("copies")))
    keyed = docs.select(
        F.struct(*[named(c) for c in docs.columns]).alias("_mix_row"),
        F.struct(
            named(id_col).cast("long").alias("doc_id"),
            named(source_col).cast("string").alias("source"),
            words(named(text_col).cast("string")).alias("size"),
        ).alias("_mix_key"),
        F.xxhash64(named(text_col)).alias("_mix_order"),
    ).withColumn("_mix_n", F.row_number().over(order))
    joined = keyed.join(plan, keyed["_mix_key"].eqNullSafe(plan["_mix_key"]) & (keyed["_mix_n"] == plan["_mix_n"]))
    repeated = joined.where("copies > 0").select("_mix_row", F.explode(F.sequence(F.lit(1), "copies")).alias("_mix_copy"))
    return repeated.select(*[F.col("_mix_row")[c].alias(c) for c in docs.columns])


# The same in DuckDB's SQL, over ``documents``.
MIX_SQL = """
with sizes as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::bigint as size
  from documents
), totals as (
  select source, sum(size)::bigint as source_size from sizes group by source
), weighted as (
  select *, 3 * source_size as cap,
    (row_number() over (order by source asc nulls last) - 1) % 3 + 1 as w
  from totals
), ordered as (
  select *,
    sum(source_size) over () - coalesce(sum(cap) over (order by cap / w, source asc nulls last
      rows between unbounded preceding and 1 preceding), 0) as remain,
    sum(w) over (order by cap / w, source asc nulls last
      rows between current row and unbounded following) as w_rest
  from weighted
), limited as (
  select *, cap::hugeint * w_rest::hugeint < remain::hugeint * w::hugeint as is_full from ordered
), targets as (
  select source, source_size,
    case when is_full then cap::double else
      ((sum(source_size) over () - sum(case when is_full then cap else 0 end) over ())::hugeint * w)::double
      / (sum(case when is_full then 0 else w end) over ())::double end as target,
    ('0x' || substr(md5(coalesce('s' || source, 'n')), 1, 13))::bigint / 4503599627370496.0::double as shift
  from limited
), parts as (
  select source, length(bin(size)) as magnitude, ceil(count(*) / 1000.0)::bigint as parts
  from sizes group by 1, 2
), ranked as (
  select s.doc_id, s.source, s.size,
    row_number() over (partition by s.source
      order by length(bin(s.size)), coalesce((s.doc_id % p.parts + p.parts) % p.parts, 0),
        s.size, s.doc_id asc nulls first) as k
  from sizes s join parts p
    on s.source is not distinct from p.source and length(bin(s.size)) = p.magnitude
)
select r.doc_id, r.size, t.source_size, t.target,
  (coalesce(floor(t.target / nullif(t.source_size, 0) * r.k + t.shift)
    - floor(t.target / nullif(t.source_size, 0) * (r.k - 1) + t.shift), 0) * r.size)::bigint as taken
from ranked r join targets t on r.source is not distinct from t.source
""".strip()
