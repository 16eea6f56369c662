"""Quality rules judged by host: failures per host, shrunk towards what hosts have in common.

Every document is measured and held against a few rules. The failures of each rule are
counted per host. A host with few documents says little about itself, so its rate is
shrunk: the rates of all hosts are described by a beta distribution (by its first two
moments, less the variance that mere sampling explains), and a host's rate is the mean of
that distribution after the host's own documents have been seen. A host where more than
half of the documents must be expected to break a rule is rejected, and the verdict goes
back to its documents.

Everything is built-in expressions. Texts are read once, never leave their task, and only
numbers are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import materialize, named

#: Fewest words, and the largest percentages of words, that pass.
LEAST_WORDS = 50
MOST_REPEATED = 50
MOST_SYMBOLS = 20
MOST_DUPLICATE_LINES = 30
#: Smallest and largest mean length of words that passes.
WORD_LENGTHS = (2, 15)
#: A host is rejected beyond this shrunken rate of failures of any rule.
MOST_FAILING = 0.5
#: Prior documents at most, where hosts differ no more than chance makes them differ.
MOST_PRIOR = 1_000_000
#: Words of a window whose repetition counts.
WINDOW = 3

_SPACE = r"[\x20\x09-\x0D]+"
_SYMBOL = "[#*$%&|<>]"
_NOT_SPACE = r"[^\x20\x09-\x0D]"
#: Rates are whole billionths, so that their sums do not depend on the order of rows.
_UNIT = 1_000_000_000


def rules() -> dict[str, Column]:
    """The rules by name, each true where the measures of a document break it."""
    n = F.col("n_words")
    return {
        "short": n < LEAST_WORDS,
        "repeated": 100 * F.col("n_repeat_words") > MOST_REPEATED * n,
        "symbols": 100 * F.col("n_symbols") > MOST_SYMBOLS * n,
        "duplicate_lines": 100 * F.col("n_dup_lines") > MOST_DUPLICATE_LINES * F.col("n_lines"),
        "word_length": (F.col("word_chars") < WORD_LENGTHS[0] * n)
        | (F.col("word_chars") > WORD_LENGTHS[1] * n),
    }


def host(name: Column) -> Column:
    """The domain of a URL, in lower case and without ``www.``; other names as they are.

    A null or blank name is no host.
    """
    domain = F.regexp_replace(F.lower(F.try_parse_url(name, F.lit("HOST"))), r"^www\.", "")
    return F.coalesce(domain, F.when(F.trim(name) != "", name))


def measure(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source"
) -> DataFrame:
    """``doc_id``, ``host`` and the numbers that the rules read, one row per row of ``docs``.

    A null text has no words. Rows are measured alone, so repeated ids and extra columns
    do not matter. A text and its words, hashed by windows, must fit in a task. Windows
    are told apart by 64 bits.
    """
    text = F.coalesce(named(text_col).cast("string"), F.lit(""))
    split = docs.select(
        named(id_col).cast("long").alias("doc_id"),
        host(named(host_col).cast("string")).alias("host"),
        F.array_remove(F.split(text, _SPACE), "").alias("words"),
        F.filter(F.split(text, "\n"), lambda line: line.rlike(_NOT_SPACE)).alias("lines"),
        F.regexp_count(text, F.lit(_SYMBOL)).cast("long").alias("n_symbols"),
    )
    # Every array below is read at least twice, so that no projection is merged into the
    # next one and evaluated there for each element.
    words, windows, places = F.col("words"), F.col("windows"), F.col("places")
    first = F.slice(words, 1, F.greatest(F.size(words) - (WINDOW - 1), F.lit(0)))
    hashed = F.transform(
        first,
        lambda w, i: F.struct(
            F.xxhash64(w, *[F.get(words, i + k) for k in range(1, WINDOW)]).alias("h"), i.alias("i")
        ),
    )
    counted = split.select(
        "doc_id",
        "host",
        F.size(words).cast("long").alias("n_words"),
        F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
        "n_symbols",
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.sort_array(hashed).alias("windows"),
    )
    equal = lambda w, i: (w["h"] == F.get(windows, i - 1)["h"]) | (w["h"] == F.get(windows, i + 1)["h"])
    repeated = F.transform(F.filter(windows, equal), lambda w: w["i"])
    found = counted.withColumn("places", F.sort_array(repeated)).drop("windows")
    # A window covers its words up to where the next repeated window begins.
    covered = F.aggregate(
        F.transform(
            places, lambda at, i: F.coalesce(F.least(F.get(places, i + 1) - at, F.lit(WINDOW)), F.lit(WINDOW))
        ),
        F.lit(0).cast("long"),
        lambda total, x: total + x,
    )
    return found.withColumn("n_repeat_words", covered).drop("places")


def host_rates(measured: DataFrame) -> DataFrame:
    """``host``, ``docs`` and one shrunken rate ``rate_<rule>`` per rule.

    Rows of ``measured`` without a host are not counted. One row per host is shuffled by
    each task; the prior is one row of sums over the hosts. With one host, or hosts that
    differ no more than by chance, all rates are drawn to the common one.
    """
    broken = rules()
    counts = (
        measured.where(F.col("host").isNotNull())
        .groupBy("host")
        .agg(F.count("*").alias("docs"), *[F.count_if(c).alias(f"failed_{r}") for r, c in broken.items()])
    )
    counts = materialize(counts, "hosts")
    exact = lambda c: c.cast("decimal(38,0)")
    sums = [F.count("*").alias("n"), F.sum(F.expr(f"{_UNIT} div docs")).alias("inverse")]
    for r in broken:
        rate = F.expr(f"{_UNIT} * failed_{r} div docs")
        sums += [F.sum(exact(rate)).alias(f"s_{r}"), F.sum(exact(rate) * exact(rate)).alias(f"ss_{r}")]
    total = counts.agg(*sums)
    prior = []
    for r in broken:
        n = F.col("n").cast("double")
        mean = F.col(f"s_{r}").cast("double") / (n * _UNIT)
        square = F.col(f"ss_{r}").cast("double") / (n * _UNIT * _UNIT)
        spread = mean * (1 - mean)
        # The variance of the rates less what sampling adds to it, host by host.
        excess = (square - mean * mean) - spread * (F.col("inverse").cast("double") / (n * _UNIT))
        strength = F.when(
            excess * MOST_PRIOR > spread, F.greatest(spread / excess - 1, F.lit(0.0))
        ).otherwise(F.lit(float(MOST_PRIOR)))
        prior += [(mean * strength).alias(f"a_{r}"), strength.alias(f"w_{r}")]
    prior_row = total.where("n > 0").select(*prior)
    number = lambda c: prior_row.select(c).scalar()
    shrunk = [
        ((F.col(f"failed_{r}") + number(f"a_{r}")) / (F.col("docs") + number(f"w_{r}"))).alias(f"rate_{r}")
        for r in broken
    ]
    return counts.select("host", "docs", *shrunk)


def rejected_hosts(rates: DataFrame, most: float = MOST_FAILING) -> DataFrame:
    """The hosts whose shrunken rate of any rule exceeds ``most``."""
    worst = F.greatest(*[F.col(f"rate_{r}") for r in rules()], F.lit(0.0))
    return rates.where(worst > most).select("host")


def judge(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
    most: float = MOST_FAILING,
) -> DataFrame:
    """The measures of every row of ``docs``, with ``base_failed``, ``host_failed`` and ``kept``.

    ``base_failed`` says that the document itself is too short or repeats itself too much.
    ``host_failed`` is the verdict on its host; a document without a host is judged on its
    own. ``kept`` is true where neither holds. An empty table gives an empty one. Only the
    rejected hosts are joined back: Spark broadcasts them if it finds them small, and
    splits a host with many documents if not.
    """
    measured = materialize(measure(docs, id_col, text_col, host_col), "measures")
    bad = rejected_hosts(host_rates(measured), most).withColumn("host_failed", F.lit(True))
    broken = rules()
    return (
        measured.join(bad, "host", "left")
        .withColumn("host_failed", F.coalesce("host_failed", F.lit(False)))
        .withColumn("base_failed", broken["short"] | broken["repeated"])
        .withColumn("kept", ~F.col("base_failed") & ~F.col("host_failed"))
    )


# The same in DuckDB's SQL, over ``documents``. Sources there are names, not URLs.
HOST_RULES_SQL = r"""
with texts as (
  select row_number() over () as rid, doc_id, nullif(trim(source), '') as host, coalesce(text, '') as text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines
  from documents
), placed as (
  select rid, unnest(w) as word, unnest(range(len(w))) as i from texts
), triples as (
  select rid, i, word || ' ' || lead(word, 1) over following || ' ' || lead(word, 2) over following as triple
  from placed window following as (partition by rid order by i)
), windows as (
  select rid, i, count(*) over (partition by rid, triple) as times from triples where triple is not null
), repeated as (
  select rid, count(distinct place) as n_repeat_words
  from (select rid, unnest([i, i + 1, i + 2]) as place from windows where times > 1)
  group by rid
), measured as (
  select rid, doc_id, host, len(w)::bigint as n_words,
    length(array_to_string(w, ''))::bigint as word_chars,
    (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::bigint as n_symbols,
    len(lines)::bigint as n_lines,
    (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines,
    coalesce(n_repeat_words, 0)::bigint as n_repeat_words
  from texts left join repeated using (rid)
), broken as (
  select host, unnest(range(5)) as rule, unnest([
    n_words < 50, 100 * n_repeat_words > 50 * n_words, 100 * n_symbols > 20 * n_words,
    100 * n_dup_lines > 30 * n_lines, word_chars < 2 * n_words or word_chars > 15 * n_words]) as failed
  from measured where host is not null
), counts as (
  select host, rule, count(*) as docs, count(*) filter (where failed) as failed from broken group by host, rule
), moments as (
  select rule, count(*)::double as n, sum(1000000000 // docs)::double as inverse,
    sum(1000000000::hugeint * failed // docs)::double / (count(*)::double * 1000000000) as mean,
    sum((1000000000::hugeint * failed // docs) * (1000000000::hugeint * failed // docs))::double
      / (count(*)::double * 1000000000 * 1000000000) as square
  from counts group by rule
), excesses as (
  select rule, mean, mean * (1 - mean) as spread,
    (square - mean * mean) - mean * (1 - mean) * (inverse / (n * 1000000000)) as excess
  from moments
), prior as (
  select rule, mean, case when excess * 1000000 > spread then greatest(spread / excess - 1, 0.0) else 1000000.0 end as strength
  from excesses
), rejected as (
  select distinct host from counts join prior using (rule)
  where (failed + mean * strength) / (docs + strength) > 0.5
), judged as (
  select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from measured
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and r.host is null as kept
from judged left join rejected r using (host)
""".strip()
