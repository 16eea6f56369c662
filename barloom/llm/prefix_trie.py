"""The trie of the turns that conversations begin with.

A turn is known by 16 bytes of its digest, a conversation by the digests of its turns, its
path. Sorted by path, the members of a node stand together. The sorted order is cut into
shards by separators: short prefixes of sampled paths, and ids inside a run of equal
paths. The separators' own trie is the skeleton, and it goes to every task.

A node that lies in two shards begins the separator between them, so it is in the
skeleton. All other nodes are finished inside one shard, by a stack along the sorted
paths. For skeleton nodes each shard hands on what it has of them, and these partial
aggregates are reduced: members and sums by addition, ids by the minimum, and the digest of
the ids that end there from pieces in the order of the shards.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm.common import map_arrow, materialize, named

#: Bytes of a turn's digest.
MARK = 16
#: Conversations of a shard, on average, and shards at most.
SHARD_ROWS = 50_000
MOST_SHARDS = 8_192
#: Sampled paths per shard, and turns of them that are looked at: these bound the skeleton.
SAMPLED = 8
DEEP = 64
#: Bytes of ids that are handed on at once, and rows of an output batch.
PIECE = 1 << 16
BATCH = 4_096

_PATHS = "conv_id long, path binary, chars binary"
_OUT = (
    "kind int, conv_id long, depth long, parent long, skeleton int, above array<int>, n long, "
    "children long, leaves long, saved long, chars long, shard int, piece int, ends string"
)
_NODE, _PARTIAL, _PIECE = 0, 1, 2
_NOTHING = hashlib.sha256(b"").hexdigest()
_FIRST = -(2**63)


def marked_turns(
    conversations: DataFrame,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """``conv_id``, ``turn``, ``mark`` and ``chars`` of every turn; texts stay where they are.

    Null roles and texts are empty. Rows without an id belong to no conversation and are
    left out.
    """
    role = F.coalesce(named(role_col).cast("string"), F.lit(""))
    text = F.coalesce(named(text_col).cast("string"), F.lit(""))
    whole = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)
    return conversations.select(
        named(id_col).cast("long").alias("conv_id"),
        named(turn_col).cast("long").alias("turn"),
        F.unhex(F.substring(whole, 1, 2 * MARK)).alias("mark"),
        F.length(text).cast("int").alias("chars"),
    ).where("conv_id is not null")


def as_they_are(turns: DataFrame) -> DataFrame:
    """Rows for :func:`paths` of conversations that keep their own turns."""
    return turns.select("conv_id", F.lit(2).alias("part"), "turn", "mark", "chars", F.lit(0).alias("skip"))


def share_openings(turns: DataFrame, family: int = 100, most: int = 6) -> DataFrame:
    """Rows for :func:`paths`: each conversation opens with turns of its family's first.

    Conversation ``c`` gets the first ``h`` turns of conversation ``c - c % family``
    instead of its own first ``h``, where ``h`` is ``crc32`` of the decimal ``c`` modulo
    ``most``. Remainders have the sign of ``c``. Only the first turns of a conversation are
    looked up, and each task sends no more of them than that.
    """
    turns = materialize(turns, "turns")
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "mark")
    heads = turns.withColumn("place", F.row_number().over(order)).where(F.col("place") <= most - 1)
    h = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(most)).cast("int")
    ids = turns.select("conv_id").distinct().withColumn("skip", h)
    found = heads.select(F.col("conv_id").alias("first"), F.col("place").cast("long").alias("turn"), "mark", "chars")
    opening = (
        ids.withColumn("first", F.col("conv_id") - F.col("conv_id") % family)
        .join(found, "first")
        .where(F.col("turn") <= F.col("skip"))
    )
    none = F.lit(0).alias("skip")
    return (
        turns.select("conv_id", F.lit(2).alias("part"), "turn", "mark", "chars", none)
        .union(opening.select("conv_id", F.lit(1), "turn", "mark", "chars", none))
        .union(
            ids.select(
                "conv_id", F.lit(0), F.lit(0).cast("long"), F.lit(None).cast("binary"), F.lit(None).cast("int"), "skip"
            )
        )
    )


def paths(rows: DataFrame) -> DataFrame:
    """One row per conversation: its id, the digests of its turns, and their lengths.

    Rows of ``part`` 0 name a conversation and how many turns of part 2 it skips; parts 1
    and 2 are turns, in this order, by turn (null first) and then digest. A path, 20 bytes a
    turn, is held by one task; texts never are.
    """
    by = [F.col("conv_id"), F.col("part"), F.asc_nulls_first("turn"), F.col("mark")]
    laid = rows.select("conv_id", "part", "skip", "mark", "chars", "turn").repartition("conv_id")
    return map_arrow(laid.sortWithinPartitions(*by).drop("turn"), _assemble, _PATHS)


def _assemble(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out: list[tuple] = []
    conv, skip, marks, chars = None, 0, [], []
    for batch in batches:
        for c, part, skipped, mark, n in zip(*(x.to_pylist() for x in batch.columns)):
            if c != conv:
                if conv is not None:
                    out.append((conv, b"".join(marks), np.array(chars, "<i4").tobytes()))
                conv, skip, marks, chars = c, 0, [], []
            if part == 0:
                skip = skipped
            elif part == 2 and skip:
                skip -= 1
            else:
                marks.append(mark)
                chars.append(n)
            if len(out) >= BATCH:
                yield _batch(out, _PATHS)
                out = []
    if conv is not None:
        out.append((conv, b"".join(marks), np.array(chars, "<i4").tobytes()))
    yield _batch(out, _PATHS)


_ARROW = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary(), "array<int>": pa.list_(pa.int32())}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [f.split() for f in schema.split(", ")]
    columns = list(zip(*rows)) if rows else [()] * len(fields)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, _ARROW[kind]) for c, (_, kind) in zip(columns, fields)], names=[f[0] for f in fields]
    )


def _common(a: bytes, b: bytes) -> int:
    """Number of turns that two paths begin with alike."""
    low, high = 0, min(len(a), len(b)) // MARK
    if a[: high * MARK] == b[: high * MARK]:
        return high
    while high - low > 1:
        middle = (low + high) // 2
        if a[low * MARK : middle * MARK] == b[low * MARK : middle * MARK]:
            low = middle
        else:
            high = middle
    return low


def separators(sample: list[tuple[bytes, int]], shards: int) -> list[tuple[bytes, int]]:
    """Cuts between shards from sampled (path, id), each no longer than it needs to be.

    A cut is the shortest prefix of a path that is beyond the sampled path before it; in a
    run of equal paths it is the whole path and an id.
    """
    sample = sorted(sample)
    cuts = []
    for k in range(1, shards):
        at = k * len(sample) // shards
        if not 0 < at < len(sample):
            continue
        (before, _), (path, conv) = sample[at - 1], sample[at]
        alike = _common(before, path)
        cuts.append((path, conv) if before == path else (path[: (alike + 1) * MARK], _FIRST))
    return sorted(set(cuts))


class Skeleton:
    """The trie of the separators' paths: numbers by (parent's number, digest)."""

    def __init__(self, cuts: list[tuple[bytes, int]]):
        self.cuts = cuts
        self.nodes: dict[tuple[int, bytes], int] = {}
        for path, _ in cuts:
            node = 0
            for at in range(0, len(path), MARK):
                node = self.nodes.setdefault((node, path[at : at + MARK]), len(self.nodes) + 1)

    def shard(self, path: bytes, conv: int) -> int:
        return bisect_right(self.cuts, (path, conv))


def _deal(skeleton: Skeleton):
    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            convs, routes = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            shards = [skeleton.shard(p, c) for c, p in zip(convs, routes)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(shards, pa.int32()), *batch.columns], names=["shard", "conv_id", "path", "chars"]
            )

    return task


class _Frame:
    """An open node of the stack."""

    __slots__ = ("chars", "children", "depth", "ends", "least", "leaves", "n", "pending", "saved", "skeleton")

    def __init__(self, depth: int, chars: int, skeleton: int | None):
        self.depth, self.chars, self.skeleton = depth, chars, skeleton
        self.n = self.children = self.leaves = self.saved = 0
        self.least: int | None = None
        #: Finished children, which wait for this node's smallest member.
        self.pending: list[tuple] = []
        self.ends: Ends | Pieces | None = None

    def join(self, n: int, least: int) -> None:
        self.n += n
        self.least = least if self.least is None else min(self.least, least)


class Ends:
    """Digest of ids in order, joined by commas."""

    def __init__(self):
        self.hash, self.any = hashlib.sha256(), False

    def add(self, ids: str) -> None:
        self.hash.update((("," if self.any else "") + ids).encode())
        self.any = True


class Pieces:
    """Ids in order, joined by commas, cut into pieces."""

    def __init__(self, most: int):
        self.held, self.size, self.number, self.most = [], 0, 0, most

    def add(self, conv: str) -> str | None:
        self.held.append(conv)
        self.size += len(conv) + 1
        return self.cut() if self.size >= self.most else None

    def cut(self) -> str:
        piece, self.held, self.size = ",".join(self.held), [], 0
        self.number += 1
        return piece


def _walk(skeleton: Skeleton, most: int):
    """Task over rows (shard, conv_id, path, chars), sorted by shard, path and id."""

    def row(kind, conv=None, depth=None, parent=None, number=None, above=None, n=None, children=None, leaves=None, saved=None, chars=None, shard=None, piece=None, ends=None):
        return (kind, conv, depth, parent, number, above, n, children, leaves, saved, chars, shard, piece, ends)

    def close(stack: list[_Frame], shard: int, out: list[tuple]) -> None:
        top = stack.pop()
        parent = stack[-1] if stack else None
        if top.skeleton is not None:
            if top.ends is not None and top.ends.held:
                number = top.ends.number
                out.append(row(_PIECE, number=top.skeleton, shard=shard, piece=number, ends=top.ends.cut()))
            above = [f.skeleton for f in stack]
            out.append(row(_PARTIAL, top.least, top.depth, None, top.skeleton, above, top.n, top.children, top.leaves, top.saved, top.chars))
            if parent is not None:
                parent.join(top.n, top.least)
                parent.leaves += top.leaves
                parent.saved += top.saved
            return
        leaves = top.leaves or 1
        saved = top.saved + (top.n - 1) * top.chars
        out.extend(row(_NODE, *child[:2], top.least, None, None, *child[2:]) for child in top.pending)
        ends = top.ends.hash.hexdigest() if top.ends is not None else _NOTHING
        done = (top.least, top.depth, top.n, top.children, leaves, saved, None, None, None, ends)
        parent.join(top.n, top.least)
        parent.children += 1
        parent.leaves += leaves
        parent.saved += saved
        if parent.skeleton is None:
            parent.pending.append(done)
        else:
            out.append(row(_NODE, *done[:2], None, parent.skeleton, None, *done[2:]))

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        stack: list[_Frame] = []
        last, shard = b"", None
        for batch in batches:
            for s, conv, path, chars in zip(*(x.to_pylist() for x in batch.columns)):
                if s != shard:
                    while stack:
                        close(stack, shard, out)
                    stack, last, shard = [_Frame(0, 0, 0)], b"", s
                alike = _common(last, path)
                while len(stack) > alike + 1:
                    close(stack, shard, out)
                lengths = np.frombuffer(chars, "<i4")
                for depth in range(alike + 1, len(path) // MARK + 1):
                    over = stack[-1].skeleton
                    mark = path[(depth - 1) * MARK : depth * MARK]
                    number = None if over is None else skeleton.nodes.get((over, mark))
                    stack.append(_Frame(depth, int(lengths[depth - 1]), number))
                top, last = stack[-1], path
                top.join(1, conv)
                if top.ends is None:
                    top.ends = Ends() if top.skeleton is None else Pieces(most)
                number = None if top.skeleton is None else top.ends.number
                piece = top.ends.add(str(conv))
                if piece is not None:
                    out.append(row(_PIECE, number=top.skeleton, shard=shard, piece=number, ends=piece))
                if len(out) >= BATCH:
                    yield _batch(out, _OUT)
                    out = []
        while stack:
            close(stack, shard, out)
        yield _batch(out, _OUT)

    return task


def _digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests (skeleton, ends) from pieces in order; one piece is held at a time."""
    out: list[tuple] = []
    node, ends = None, Ends()
    for batch in batches:
        for number, piece in zip(*(x.to_pylist() for x in batch.columns)):
            if number != node:
                if node is not None:
                    out.append((node, ends.hash.hexdigest()))
                node, ends = number, Ends()
            ends.add(piece)
    if node is not None:
        out.append((node, ends.hash.hexdigest()))
    yield _batch(out, "skeleton int, ends string")


def prefix_trie(rows: DataFrame, shards: int | None = None) -> DataFrame:
    """One row per node of the trie of the conversations in ``rows``, as :func:`paths` reads them.

    ``conv_id`` is the node's smallest member, ``depth`` its number of turns; together they
    name it. ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves`` (childless nodes
    below, or the node itself), ``saved_tokens`` (over the subtree, code points of a node's
    last text times its members but one), and ``ends_sha256`` of the ids that end there.
    Conversations without turns are members of the root; equal ones share all their nodes.
    Ids must not repeat between conversations. An empty table has no nodes.

    On the driver: ``SAMPLED`` times ``shards`` prefixes of ``DEEP`` turns, from which the
    skeleton is made. Nodes of a shard wait in memory for their parent's end.
    """
    spark = rows.sparkSession
    table = materialize(paths(rows), "paths")
    n = table.count()
    if shards is None:
        wanted = max(-(-n // SHARD_ROWS), int(spark.conf.get("spark.sql.shuffle.partitions")))
        shards = min(wanted, MOST_SHARDS)
    chosen = F.pmod(F.xxhash64("conv_id"), F.lit(max(n, 1))) < SAMPLED * shards
    sample = table.where(chosen).select(F.substring("path", 1, DEEP * MARK).alias("path"), "conv_id")
    skeleton = Skeleton(separators([(bytes(r["path"]), r["conv_id"]) for r in sample.collect()], shards))
    dealt = map_arrow(table, _deal(skeleton), "shard int, " + _PATHS)
    laid = dealt.repartitionById(shards, F.col("shard")).sortWithinPartitions("shard", "path", "conv_id")
    found = materialize(map_arrow(laid, _walk(skeleton, PIECE), _OUT), "nodes")

    spanning = _reduce(found)
    # The skeleton has at most shards times DEEP nodes, so this is safe to broadcast.
    parents = F.broadcast(spanning.select("skeleton", F.col("conv_id").alias("over")))
    inside = found.where(F.col("kind") == _NODE).join(parents, "skeleton", "left")
    names = ["conv_id", "depth", "parent", "n", "children", "leaves", "saved", "ends"]
    nodes = inside.withColumn("parent", F.coalesce("parent", "over")).select(*names).unionByName(spanning.select(*names))
    return nodes.select(
        "conv_id",
        "depth",
        F.col("parent").alias("parent_conv_id"),
        F.col("n").alias("n_convs"),
        F.col("children").alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"),
        F.col("ends").alias("ends_sha256"),
    )


def _reduce(found: DataFrame) -> DataFrame:
    """The skeleton's nodes from what the shards have of them; never more than its size.

    A shard's sums hold what is below a node outside the skeleton. What skeleton nodes add
    themselves is known only now, and goes to all of their ancestors.
    """
    total = lambda c: F.sum(c).alias(c)
    parts = (
        found.where(F.col("kind") == _PARTIAL)
        .groupBy("skeleton")
        .agg(
            F.min("conv_id").alias("conv_id"),
            *[F.any_value(c).alias(c) for c in ("depth", "above", "chars")],
            *[total(c) for c in ("n", "children", "leaves", "saved")],
        )
    )
    over: Column = F.element_at("above", -1)
    parts = materialize(parts.withColumn("over", F.when(F.size("above") > 0, over)), "skeleton")
    kids = parts.groupBy("over").agg(F.count("*").alias("kids"))
    kids = kids.where("over is not null").withColumnRenamed("over", "skeleton")
    whole = parts.join(kids, "skeleton", "left").withColumn("children", F.col("children") + F.coalesce("kids", F.lit(0)))
    own = whole.select(
        F.explode(F.concat("above", F.array("skeleton"))).alias("skeleton"),
        F.when(F.col("children") == 0, 1).otherwise(0).alias("own_leaves"),
        ((F.col("n") - 1) * F.col("chars")).alias("own_saved"),
    )
    sums = own.groupBy("skeleton").agg(F.sum("own_leaves").alias("own_leaves"), F.sum("own_saved").alias("own_saved"))
    pieces = found.where(F.col("kind") == _PIECE).select("skeleton", "shard", "piece", "ends")
    ordered = pieces.repartition("skeleton").sortWithinPartitions("skeleton", "shard", "piece")
    digests = map_arrow(ordered.select("skeleton", "ends"), _digest, "skeleton int, ends string")
    names = parts.select(F.col("skeleton").alias("over"), F.col("conv_id").alias("parent"))
    return (
        whole.join(sums, "skeleton")
        .join(digests, "skeleton", "left")
        .join(names, "over", "left")
        .select(
            "skeleton",
            "conv_id",
            "depth",
            "parent",
            "n",
            "children",
            (F.col("leaves") + F.col("own_leaves")).alias("leaves"),
            (F.col("saved") + F.col("own_saved")).alias("saved"),
            F.coalesce("ends", F.lit(_NOTHING)).alias("ends"),
        )
    )


# The same in DuckDB's SQL, over ``conversations``. The checksum works bit by bit.
TRIE_SQL = r"""
with turns as (
  select conv_id, turn, coalesce(text, '') as text,
    sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) as mark
  from conversations where conv_id is not null
), placed as (
  select conv_id, mark, length(text) as chars,
    row_number() over (partition by conv_id order by turn nulls first, substr(mark, 1, 32)) as place
  from turns
), ids as (
  select conv_id, conv_id - conv_id % 100 as family,
    xor(4294967295, list_reduce(
      list_prepend(4294967295::bigint, list_transform(string_split(conv_id::varchar, ''), lambda x: ord(x)::bigint)),
      lambda a, x: list_reduce(
        list_prepend(xor(a, x), [0, 1, 2, 3, 4, 5, 6, 7]::bigint[]),
        lambda v, k: xor(v >> 1, (v & 1) * 3988292384)))) % 6 as h
  from (select distinct conv_id from placed)
), rebuilt as (
  select i.conv_id, 1 as part, p.place, p.mark, p.chars
  from ids i join placed p on p.conv_id = i.family and p.place <= i.h
  union all
  select conv_id, 2, place, mark, chars from ids join placed using (conv_id) where place > h
), deep as (
  select conv_id, mark, chars, row_number() over (partition by conv_id order by part, place) as depth from rebuilt
), steps as (
  select conv_id, depth, chars,
    sha256(string_agg(mark, '') over (partition by conv_id order by depth rows unbounded preceding)) as node
  from deep
  union all
  select conv_id, 0, 0, '' from ids
), nodes as (
  select node, depth, any_value(chars) as chars, min(conv_id) as conv_id, count(*) as n_convs from steps group by node, depth
), links as (
  select c.node, p.node as parent, p.conv_id as parent_conv_id
  from nodes c join steps s on s.conv_id = c.conv_id and s.depth = c.depth - 1 join nodes p on p.node = s.node
), kids as (
  select parent as node, count(*) as n_children from links group by parent
), own as (
  select n.*, coalesce(n_children, 0) as n_children from nodes n left join kids using (node)
), sums as (
  select s.node, count(*) filter (where o.n_children = 0) as n_leaves, sum((o.n_convs - 1) * o.chars) as saved_tokens
  from own o join steps s on s.conv_id = o.conv_id and s.depth <= o.depth
  group by s.node
), ends as (
  select node, string_agg(conv_id::varchar, ',' order by conv_id) as ids
  from steps where (conv_id, depth) in (select (conv_id, max(depth)) from steps group by conv_id)
  group by node
)
select conv_id, depth::bigint as depth, parent_conv_id, n_convs::bigint as n_convs, n_children::bigint as n_children,
  n_leaves::bigint as n_leaves, saved_tokens::bigint as saved_tokens, sha256(coalesce(ids, '')) as ends_sha256
from own join sums using (node) left join links using (node) left join ends using (node)
""".strip()
