"""How the sources of a language differ in the terms they use.

Texts are cut into terms on their UTF-8 bytes: one translate table lowers A to Z and
blanks every other ASCII byte, ``bytes.split`` cuts, and a ``Counter`` per document gives
how often each term occurs, and that the document has it. Counters of one language and
source are added up inside the task; what leaves it is one row per language, source and
term. All later arithmetic is on whole numbers.

Shares of terms that a source lacks count too, but only terms that a source has are ever
stored. Sources are compared in blocks of sources by chunks of terms: a task holds one
small matrix, filled with each source's share of an absent term.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm.common import apply_arrow, map_arrow, materialize, named, slices

#: A term is kept in a language if so many of its documents have it.
LEAST_DOCS = 3
#: Ranks of terms that are reported.
TOP_TERMS = 200
#: Shares are whole billionths, and never zero.
UNIT = 1_000_000_000
#: Terms held by a task before it hands them on.
HELD_TERMS = 200_000
#: Bytes of a text that are cut at once.
PIECE = 4 << 20
#: Sources and terms that meet in one matrix: at most two blocks by one chunk.
BLOCK = 64
CHUNK = 4_096

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_COUNTS = "lang string, source string, term string, n long, docs long"


def terms(text: bytes) -> Counter:
    """How often each term occurs in a text of UTF-8 bytes."""
    flat = text.translate(_LOWER)
    found: Counter = Counter()
    at = 0
    while at < len(flat):
        end = flat.find(b" ", at + PIECE)
        end = len(flat) if end < 0 else end
        found.update(flat[at:end].split())
        at = end
    return found


def _count(most: int):
    """Task that gives rows (lang, source, term, n, docs); the empty term is the group itself."""

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        distinct = 0
        for piece in slices(batches, text=2):
            for lang, source, text in zip(*(c.to_pylist() for c in piece.columns)):
                n, docs = held.setdefault((lang, source), (Counter(), Counter()))
                before = len(docs)
                found = terms(text)
                n.update(found)
                docs.update(list(found))
                docs[b""] += 1
                distinct += len(docs) - before
                if distinct > most:
                    yield from _rows(held)
                    held, distinct = {}, 0
        yield from _rows(held)

    return task


def _rows(held: dict[tuple[str, str], tuple[Counter, Counter]]) -> Iterator[pa.RecordBatch]:
    for (lang, source), (n, docs) in held.items():
        names = list(docs)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([lang] * len(names), pa.string()),
                pa.array([source] * len(names), pa.string()),
                pa.array(names, pa.binary()).cast(pa.string()),
                pa.array([n[t] for t in names], pa.int64()),
                pa.array([docs[t] for t in names], pa.int64()),
            ],
            names=["lang", "source", "term", "n", "docs"],
        )


def term_counts(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source"
) -> DataFrame:
    """``lang``, ``source``, ``term``, ``n`` (how often) and ``docs`` (in how many documents).

    Every language and source that occurs also has a row of the empty term.
    """
    blank = lambda c: F.coalesce(named(c).cast("string"), F.lit(""))
    texts = docs.select(
        blank(lang_col).alias("lang"), blank(source_col).alias("source"), blank(text_col).cast("binary").alias("text")
    )
    counted = map_arrow(texts, _count(HELD_TERMS), _COUNTS)
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _share(n: Column, total: Column) -> Column:
    """``1 + floor(UNIT * (n + 1) / total)`` without rounding or overflow; 1 of nothing."""
    exact = lambda c: c.cast("decimal(19,0)")
    whole = F.call_function("div", F.lit(UNIT).cast("decimal(10,0)") * exact(n + 1), exact(F.nullif(total, F.lit(0))))
    return F.coalesce(whole, F.lit(0)) + 1


def _distance(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def audit(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    least: int = LEAST_DOCS,
    top: int = TOP_TERMS,
) -> DataFrame:
    """``lang``, ``source``, ``part``, ``item``, ``value`` and ``rank``.

    Part ``pair`` ranks the other sources of a language by their distance, part ``term``
    the terms that a source uses more than its language does, up to rank ``top``. Ties go
    to the smaller item. Nulls in any of the three columns read as empty texts, which is a
    language, a source, or no term. Repeated rows are documents of their own. A language
    without kept terms has pairs of value 0. Other columns and ids are not read; an empty
    table gives an empty result.

    Per task: ``HELD_TERMS`` terms and the terms of one document, or one matrix. The pairs
    are as many as the result asks for. The numbers of the sources of a language meet in
    one task, one row each.
    """
    counts = materialize(term_counts(docs, text_col, lang_col, source_col), "counts")
    vocabulary = (
        counts.where("term <> ''")
        .groupBy("lang", "term")
        .agg(F.sum("n").alias("n_lang"), F.sum("docs").alias("docs"))
        .where(F.col("docs") >= least)
    )
    vocabulary = materialize(vocabulary.drop("docs"), "vocabulary")
    kept = materialize(counts.drop("docs").join(vocabulary, ["lang", "term"]), "terms")
    langs = vocabulary.groupBy("lang").agg(F.sum("n_lang").alias("lang_total"), F.count("*").alias("kept"))
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    sizes = (
        counts.where("term = ''")
        .select("lang", "source")
        .join(totals, ["lang", "source"], "left")
        .join(langs, "lang", "left")
        .fillna(0, ["total", "lang_total", "kept"])
    )
    number = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    groups = sizes.select(
        "lang",
        "source",
        number.alias("at"),
        (F.col("total") + F.col("kept")).alias("total"),
        (F.col("lang_total") + F.col("kept")).alias("lang_total"),
        "kept",
    )
    groups = materialize(groups.withColumn("absent", _share(F.lit(0).cast("long"), F.col("total"))), "groups")
    shares = (
        kept.join(groups, ["lang", "source"])
        .withColumn("p", _share(F.col("n"), F.col("total")))
        .withColumn("q", _share(F.col("n_lang"), F.col("lang_total")))
    )
    ranked = lambda df: df.withColumn(
        "rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item")))
    )
    more = shares.where(F.col("p") > F.col("q")).select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), _distance(F.col("p"), F.col("q")).alias("value")
    )
    return ranked(_pairs(groups, shares)).unionByName(ranked(more).where(F.col("rank") <= top))


def _pairs(groups: DataFrame, shares: DataFrame) -> DataFrame:
    """The distances of all ordered pairs of sources within a language."""
    chunks = F.greatest(F.ceil(F.col("kept") / F.lit(float(CHUNK))), F.lit(1)).cast("int")
    blocks = groups.groupBy("lang").agg((F.floor(F.max("at") / F.lit(BLOCK)) + 1).cast("int").alias("blocks"))
    members = groups.withColumn("chunk", F.explode(F.sequence(F.lit(0), chunks - 1))).select(
        "lang", "at", "chunk", F.lit(None).cast("string").alias("term"), F.col("absent").alias("p"), "kept"
    )
    present = shares.select(
        "lang", "at", F.pmod(F.xxhash64("term"), chunks).cast("int").alias("chunk"), "term", "p", "kept"
    )
    block = F.floor(F.col("at") / F.lit(BLOCK)).cast("int")
    dealt = (
        members.unionByName(present)
        .join(blocks, "lang")
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumns({"a": F.least(block, "other"), "b": F.greatest(block, "other")})
    )
    matrix = dealt.select("lang", "chunk", "a", "b", "at", "term", "p", "kept")
    parts = apply_arrow(
        matrix.groupBy("lang", "chunk", "a", "b"), _compare(BLOCK), "lang string, i int, j int, value long"
    )
    sums = parts.groupBy("lang", "i", "j").agg(F.sum("value").alias("value"))
    name = lambda at, label: groups.select("lang", F.col("at").alias(at), F.col("source").alias(label))
    return sums.join(name("i", "source"), ["lang", "i"]).join(name("j", "item"), ["lang", "j"]).select(
        "lang", "source", F.lit("pair").alias("part"), "item", "value"
    )


def _compare(block: int):
    """Task for the part of the distances of two blocks of sources that one chunk of terms makes.

    A chunk adds up its own terms as they are. Terms that no source here has are all alike;
    the first chunk adds them for the whole language, and each chunk takes off what it has
    counted itself.
    """

    def task(table: pa.Table) -> pa.Table:
        a, b = table["a"][0].as_py(), table["b"][0].as_py()
        term = table["term"].combine_chunks()
        absent = term.is_null().to_numpy(zero_copy_only=False)
        at = table["at"].to_numpy()
        p = table["p"].to_numpy()
        order = np.argsort(at[absent])
        who, share = at[absent][order], p[absent][order]
        codes = pc.dictionary_encode(term.filter(pa.array(~absent)))
        n = len(codes.dictionary)
        matrix = np.repeat(share[:, None], n, axis=1)
        matrix[np.searchsorted(who, at[~absent]), codes.indices.to_numpy()] = p[~absent]
        unseen = (table["kept"][0].as_py() if table["chunk"][0].as_py() == 0 else 0) - n
        first, second = who // block == a, who // block == b
        lines, columns, values = [], [], []
        for k in range(len(who)):
            value = ((matrix[k] - matrix) ** 2 // matrix).sum(axis=1) + unseen * ((share[k] - share) ** 2 // share)
            with_k = (second & first[k]) | (first & second[k])
            with_k[k] = False
            lines.append(np.full(with_k.sum(), who[k]))
            columns.append(who[with_k])
            values.append(value[with_k])
        i = np.concatenate(lines).astype(np.int32)
        return pa.table(
            {
                "lang": pa.array([table["lang"][0].as_py()] * len(i), pa.string()),
                "i": i,
                "j": np.concatenate(columns).astype(np.int32),
                "value": np.concatenate(values).astype(np.int64),
            }
        )

    return task


# The same in DuckDB's SQL, over ``documents``.
AUDIT_SQL = r"""
with texts as (
  select row_number() over () as rid, coalesce(lang, '') as lang, coalesce(source, '') as source,
    regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as w
  from documents
), tokens as (
  select rid, lang, source, unnest(w) as term from texts
), vocabulary as (
  select lang, term, count(*)::hugeint as n_lang from tokens group by lang, term having count(distinct rid) >= 3
), counts as (
  select lang, source, term, count(*)::hugeint as n
  from tokens semi join vocabulary using (lang, term) group by lang, source, term
), langs as (
  select l.lang, count(v.term)::hugeint as kept, coalesce(sum(n_lang), 0)::hugeint as lang_total
  from (select distinct lang from texts) l left join vocabulary v using (lang) group by l.lang
), sizes as (
  select g.lang, g.source, coalesce(sum(n), 0)::hugeint as total
  from (select distinct lang, source from texts) g left join counts c using (lang, source) group by g.lang, g.source
), shares as (
  select s.lang, s.source, v.term, coalesce(c.n, 0) as n,
    1 + 1000000000::hugeint * (coalesce(c.n, 0) + 1) // (s.total + l.kept) as p,
    1 + 1000000000::hugeint * (v.n_lang + 1) // (l.lang_total + l.kept) as q
  from sizes s join langs l using (lang) join vocabulary v using (lang) left join counts c using (lang, source, term)
), sums as (
  select a.lang, a.source, b.source as item, sum((a.p - b.p) * (a.p - b.p) // b.p) as value
  from shares a join shares b on a.lang = b.lang and a.term = b.term and a.source <> b.source
  group by a.lang, a.source, b.source
), parts as (
  select a.lang, a.source, 'pair' as part, b.source as item, coalesce(value, 0)::bigint as value
  from sizes a join sizes b on a.lang = b.lang and a.source <> b.source
    left join sums s on s.lang = a.lang and s.source = a.source and s.item = b.source
  union all
  select lang, source, 'term', term, ((p - q) * (p - q) // q)::bigint from shares where n > 0 and p > q
), ranked as (
  select *, row_number() over (partition by lang, source, part order by value desc, item)::int as rank from parts
)
select * from ranked where part = 'pair' or rank <= 200
""".strip()
