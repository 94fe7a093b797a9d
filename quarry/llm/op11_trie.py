"""Conversation prefix trie: burst tries over turn sequences.

A conversation is the sequence of its turns, a turn its (role, text) as a
128-bit id and the code points of its text. A node of depth d is a distinct
sequence of d first turns; its members are the conversations that start with it.

1. Conversations with the same sequence are one class (smallest conv_id, number,
   SHA-256 of the ids), so a conversation copied a million times is one row from
   then on. The ids of a class are put in order over range partitions, joined to
   pieces of ``PIECE`` ids there, and hashed piece by piece.
2. All classes start in the root's container. A container of more than ``burst``
   turns bursts: the head it leaves is the chain of nodes that all its sequences
   share (the common prefix of the least and the greatest one), and below that
   each next turn id opens a container of its own. The rounds end when no
   container is too large; a container of one sequence never is.
3. The containers left are dealt over the shards by their key, sorted, and swept:
   the sweep holds the path of the sequence before and closes the nodes that the
   next one leaves. It streams, so memory follows the longest conversation only.
4. Heads add up what their containers and lower heads hold, from the last round
   to the first.

Turns are ordered by ``turn`` (null first), equal numbers by turn id. Null role
or text is empty. Rows with a null conv_id are dropped. Repeated rows are turns
of their own. A conversation without turns is a member of the root. An empty
table gives no rows. Extra columns are ignored. Texts are read once and never
shuffled; a conversation is one row of 24 bytes for each turn.

``saved_tokens`` counts, over a node's subtree, the code points of each node's
last text for all its members but one: what storing the turn once saves.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.llm.registry import query, table
from quarry.session import stage

BURST = 1024
PIECE = 4096
HEAD_ROWS = 1_000_000
SALTS = 32
NO_ENDS = hashlib.sha256(b"").hexdigest()

NODE = ("conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, "
        "saved_tokens bigint, ends_sha256 string")


def turn_id(role, text):
    """128-bit id of a turn; the length of the role keeps (role, text) apart."""
    return F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary")))


def sequences(turns: DataFrame) -> DataFrame:
    """(conv_id, seq array<struct<id, n>>) of every conversation of ``turns`` (conv_id, turn, role, text)."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    held = turns.where("conv_id is not null").select(
        F.col("conv_id").cast("bigint"), "turn", turn_id(role, text).alias("id"), F.length(text).alias("n"))
    return held.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "id", "n"))).alias("s")).select(
        "conv_id", F.transform("s", lambda t: F.struct(t.id.alias("id"), t.n.alias("n"))).alias("seq"))


def rebuild(seqs: DataFrame) -> DataFrame:
    """(conv_id, seq): the first h turns of conversation c - c % 100, then c's own after its first h; h = crc32(c) % 6."""
    whole = seqs.withColumn("base", F.col("conv_id") - F.col("conv_id") % 100).withColumn(
        "h", (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6).cast("int"))
    bases = seqs.where("conv_id % 100 = 0").select(F.col("conv_id").alias("base"), F.slice("seq", 1, 5).alias("shared"))
    none = F.slice("seq", 1, 0)
    own = F.when(F.size("seq") > F.col("h"), F.slice("seq", F.col("h") + 1, F.greatest(F.size("seq"), F.lit(1)))).otherwise(none)
    return whole.join(bases, "base", "left").select(
        "conv_id", F.concat(F.slice(F.coalesce("shared", none), F.lit(1), F.col("h")), own).alias("seq"))


def _piece_batches(batches):
    """(class, first, n, ids): runs of a class's ordered ids, joined by commas."""
    key, ids = None, []

    def piece():
        return pa.RecordBatch.from_pydict(
            {"class": [key], "first": [ids[0]], "n": [len(ids)], "ids": [",".join(map(str, ids))]}, pieces)

    pieces = pa.schema([("class", pa.binary()), ("first", pa.int64()), ("n", pa.int64()), ("ids", pa.string())])
    for batch in batches:
        out = {"class": [], "first": [], "n": [], "ids": []}
        for k, c in zip(batch.column("class").to_pylist(), batch.column("conv_id").to_pylist()):
            if ids and (k != key or len(ids) == PIECE):
                for name, value in zip(out, (key, ids[0], len(ids), ",".join(map(str, ids)))):
                    out[name].append(value)
                ids = []
            key = k
            ids.append(c)
        yield pa.RecordBatch.from_pydict(out, pieces)
    if ids:
        yield piece()


def _hash_batches(batches):
    """(conv_id, n_convs, ends_sha256) of each class from its ordered pieces."""
    schema = pa.schema([("conv_id", pa.int64()), ("n_convs", pa.int64()), ("ends_sha256", pa.string())])
    key, first, n, digest = None, None, 0, None
    for batch in batches:
        out = []
        for k, f, m, ids in zip(*(batch.column(c).to_pylist() for c in ("class", "first", "n", "ids"))):
            if k != key:
                if digest is not None:
                    out.append((first, n, digest.hexdigest()))
                key, first, n, digest = k, f, 0, hashlib.sha256()
            digest.update((("," if n else "") + ids).encode())
            n += m
        yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], t.type) for i, t in enumerate(schema)], schema=schema)
    if digest is not None:
        yield pa.RecordBatch.from_pydict({"conv_id": [first], "n_convs": [n], "ends_sha256": [digest.hexdigest()]}, schema)


def classes(seqs: DataFrame) -> DataFrame:
    """(conv_id, n_convs, ends_sha256, seq): one row for each distinct sequence, under its smallest conv_id."""
    seqs = stage(seqs.withColumn("class", F.unhex(F.md5(F.array_join(F.transform("seq", lambda t: F.hex(t.id)), "").cast("binary")))),
                 "trie-sequences")
    ids = seqs.select("class", "conv_id")
    pieces = ids.repartitionByRange("class", "conv_id").sortWithinPartitions("class", "conv_id").mapInArrow(
        _piece_batches, "class binary, first bigint, n bigint, ids string")
    ends = pieces.repartition("class").sortWithinPartitions("class", "first").mapInArrow(
        _hash_batches, "conv_id bigint, n_convs bigint, ends_sha256 string")
    return ends.join(seqs.select("conv_id", "seq"), "conv_id")


def _with_heads(rows: DataFrame, heads: DataFrame, how: str = "inner") -> DataFrame:
    """``rows`` joined with ``heads`` (staged, one row for each key); a key may hold most rows, so beyond HEAD_ROWS it is salted."""
    if heads.count() <= HEAD_ROWS:
        return rows.join(F.broadcast(heads), "key", how)
    salted = heads.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.withColumn("_salt", F.pmod(F.xxhash64("conv_id"), F.lit(SALTS)).cast("int")).join(
        salted, ["key", "_salt"], how).drop("_salt")


class _Path:
    """The open nodes from a container's top to the end of the sequence before."""

    def __init__(self, parent: int | None, key: bytes, parent_key: bytes | None):
        self.parent, self.key, self.parent_key = parent, key, parent_key
        self.ids, self.nodes = [], []  # per node: conv_id, n_convs, children, leaves, saved, ends, len

    def close(self, depth: int, top: int, out: list) -> None:
        """Close the open nodes deeper than ``depth`` (kept: depth - top + 1 of them)."""
        keep = depth - top + 1
        while len(self.nodes) > keep:
            conv, n, children, leaves, saved, ends, length = self.nodes.pop()
            self.ids.pop()
            leaves, saved = leaves or 1, saved + (n - 1) * length
            if self.nodes:
                up = self.nodes[-1]
                up[0], up[1], up[2], up[3], up[4] = min(up[0], conv), up[1] + n, up[2] + 1, up[3] + leaves, up[4] + saved
            out.append((conv, top + len(self.nodes), n, children, leaves, saved, ends,
                        None if self.nodes else self.parent_key, self.key))


def _sweep_batches(batches):
    """Nodes of the containers of a partition, whose rows come sorted by (key, seq).

    ``parent_conv_id`` is filled in when the parent closes, since only then its smallest member is known: a node waits in
    ``waiting`` under its parent's place on the path.
    """
    schema = pa.schema([("conv_id", pa.int64()), ("depth", pa.int64()), ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()),
                        ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()),
                        ("ends_sha256", pa.string()), ("up", pa.binary())])
    path, top, done, waiting = None, 0, [], {}

    def settle(closed: list) -> None:
        for conv, depth, n, children, leaves, saved, ends, up, _ in closed:
            for w in waiting.pop(depth + 1, ()):
                done.append((w[0], w[1], conv, *w[2:]))
            row = (conv, depth, n, children, leaves, saved, ends, up)
            if depth == top:
                done.append((conv, depth, path.parent, *row[2:]))
            else:
                waiting.setdefault(depth, []).append(row)

    def flush():
        rows = pa.RecordBatch.from_arrays([pa.array([d[i] for d in done], f.type) for i, f in enumerate(schema)], schema=schema)
        done.clear()
        return rows

    for batch in batches:
        seqs = batch.column("seq")
        ids, lens = (c.to_pylist() for c in seqs.flatten().flatten())
        at = 0
        columns = (batch.column(c).to_pylist() for c in ("key", "up", "conv_id", "n_convs", "ends_sha256", "depth", "parent"))
        for size, key, up, conv, n, ends, depth, parent in zip(
                seqs.value_lengths().to_pylist(), *columns):
            seq, length = ids[at:at + size], lens[at:at + size]
            at += size
            if path is None or key != path.key:
                if path is not None:
                    closed = []
                    path.close(top - 1, top, closed)
                    settle(closed)
                path, top = _Path(parent, key, up), depth
                shared = top - 1
            else:
                shared = top
                for a, b in zip(path.ids[1:], seq[top:]):
                    if a != b:
                        break
                    shared += 1
                closed = []
                path.close(shared, top, closed)
                settle(closed)
            for d in range(shared + 1, size + 1):
                path.ids.append(seq[d - 1] if d else None)
                path.nodes.append([conv, 0, 0, 0, 0, NO_ENDS, length[d - 1] if d else 0])
            end = path.nodes[size - top]
            end[0], end[1], end[5] = min(end[0], conv), end[1] + n, ends
            if len(done) >= 10_000:
                yield flush()
    if path is not None:
        closed = []
        path.close(top - 1, top, closed)
        settle(closed)
    yield flush()


def nodes(found: DataFrame, burst: int = BURST) -> DataFrame:
    """Every node of the trie over ``found`` (classes: conv_id, n_convs, ends_sha256, seq)."""
    root = F.unhex(F.lit("00"))
    open_ = found.select("*", root.alias("key"), F.lit(None).cast("binary").alias("up"), F.lit(0).alias("depth"),
                         F.lit(None).cast("bigint").alias("parent"))
    open_ = stage(open_, "trie-open")
    closed, heads = [], []
    while True:
        big = stage(open_.groupBy("key").agg(F.sum(F.size("seq") - F.col("depth") + 1).alias("m"), F.count(F.lit(1)).alias("c")).where(
            (F.col("m") > burst) & (F.col("c") > 1)).select("key"), "trie-big")
        if big.isEmpty():
            closed.append(open_)
            break
        closed.append(_with_heads(open_, big, "left_anti") if big.count() <= HEAD_ROWS else open_.join(big, "key", "left_anti"))
        inside = _with_heads(open_, big)
        # the least and the greatest sequence share what all share
        spans = stage(inside.groupBy("key").agg(
            F.min("seq").alias("lo"), F.max("seq").alias("hi"), F.min("conv_id").alias("head"), F.sum("n_convs").alias("n_convs"),
            F.first("up").alias("up"), F.first("depth").alias("top"), F.first("parent").alias("parent")).select(
            "*", (F.array_position(F.zip_with("lo", "hi", lambda a, b: a.id.eqNullSafe(b.id)), False) - 1).cast("int").alias("last")
        ).drop("hi"), "trie-spans")
        below = _with_heads(inside.drop("up", "parent", "depth"), spans.select("key", "last", "head"))
        below = stage(below, "trie-below")
        ends = below.where(F.size("seq") == F.col("last")).select("key", F.col("ends_sha256").alias("ends"))
        heads.append(stage(spans.join(ends, "key", "left").withColumn(
            "lens", F.transform(F.slice("lo", F.greatest("top", F.lit(1)), F.col("last") - F.col("top") + F.when(F.col("top") > 0, 1).otherwise(0)),
                                lambda t: t.n.cast("bigint"))).drop("lo"), "trie-heads"))
        open_ = stage(below.where(F.size("seq") > F.col("last")).select(
            "conv_id", "n_convs", "ends_sha256", "seq", F.unhex(F.md5(F.concat("key", F.get("seq", F.col("last")).id, F.col("last").cast("string").cast("binary")))).alias("next"),
            F.col("key").alias("up"), (F.col("last") + 1).alias("depth"), F.col("head").alias("parent")).withColumnRenamed("next", "key"),
            "trie-open")

    held = closed[0]
    for more in closed[1:]:
        held = held.unionByName(more)
    swept = stage(held.repartition("key").sortWithinPartitions("key", "seq").select(
        "key", "up", "conv_id", "n_convs", "ends_sha256", "depth", "parent", "seq").mapInArrow(
        _sweep_batches, NODE + ", up binary"), "trie-nodes")
    out = swept.drop("up")
    tops = swept.where("up is not null").select("up", "n_leaves", "saved_tokens")
    for level in reversed(heads):
        sums = tops.groupBy(F.col("up").alias("key")).agg(
            F.count(F.lit(1)).alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("below"))
        level = stage(level.join(sums, "key"), "trie-sums")
        # the textless root has no length of its own
        lens = F.when(F.col("top") == 0, F.concat(F.array(F.lit(0).cast("bigint")), F.col("lens"))).otherwise(F.col("lens"))
        chain = level.withColumn("lens", lens).select("*", F.posexplode("lens").alias("i", "n"))
        upward = Window.partitionBy("key").orderBy(F.col("i").desc())
        chain = stage(chain.select(
            F.col("head").alias("conv_id"), (F.col("top") + F.col("i")).cast("bigint").alias("depth"),
            F.when(F.col("i") > 0, F.col("head")).otherwise(F.col("parent")).alias("parent_conv_id"), "n_convs",
            F.when(F.col("top") + F.col("i") == F.col("last"), F.col("n_children")).otherwise(1).alias("n_children"), "n_leaves",
            (F.col("below") + F.sum((F.col("n_convs") - 1) * F.col("n")).over(upward)).alias("saved_tokens"),
            F.when(F.col("top") + F.col("i") == F.col("last"), F.coalesce("ends", F.lit(NO_ENDS))).otherwise(NO_ENDS).alias("ends_sha256"),
            F.when(F.col("i") == 0, F.col("up")).alias("up")), "trie-chains")
        out = out.unionByName(chain.drop("up"))
        tops = tops.unionByName(chain.where("up is not null").select("up", "n_leaves", "saved_tokens"))
    return out


def prefix_trie(turns: DataFrame, burst: int = BURST) -> DataFrame:
    """Every node of the prefix trie over the conversations as they are."""
    return nodes(classes(sequences(turns)), burst)


def rebuilt_trie(turns: DataFrame, burst: int = BURST) -> DataFrame:
    """Every node of the prefix trie over the rebuilt conversations."""
    return nodes(classes(rebuild(stage(sequences(turns), "trie-own"))), burst)


# crc32 of a decimal conv_id, byte by byte: xor the byte, then eight shifts (the steps marked -1)
_CRC = """xor(list_reduce(list_concat([4294967295], flatten(list_transform(range(1, length(CAST(conv_id AS VARCHAR)) + 1),
  lambda i: [CAST(ascii(substr(CAST(conv_id AS VARCHAR), i, 1)) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
  lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, (a & 1) * 3988292384) END), 4294967295)"""

_SQL = rf"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
k AS (SELECT conv_id, turn, md5(length(role) || ':' || role || text) AS id, length(text) AS n FROM t),
own AS (SELECT conv_id, list(id ORDER BY turn NULLS FIRST, id) AS ids, list(n ORDER BY turn NULLS FIRST, id) AS lens FROM k GROUP BY conv_id),
hh AS (SELECT *, conv_id - conv_id % 100 AS base, {_CRC} % 6 AS h FROM own),
r AS (SELECT a.conv_id, list_concat(coalesce(b.ids, [])[1:a.h], a.ids[a.h + 1:]) AS ids,
  list_concat(coalesce(b.lens, [])[1:a.h], a.lens[a.h + 1:]) AS lens FROM hh a LEFT JOIN own b ON b.conv_id = a.base),
p AS (SELECT conv_id, unnest(range(0, len(ids) + 1)) AS depth, ids, lens FROM r),
m AS (SELECT conv_id, depth, md5(array_to_string(ids[1:depth], ',')) AS node, md5(array_to_string(ids[1:depth - 1], ',')) AS up,
  CASE WHEN depth = 0 THEN 0 ELSE lens[depth] END AS n, depth = len(ids) AS ended FROM p),
node AS MATERIALIZED (SELECT depth, node, any_value(up) AS up, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(n) AS n,
  sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ended), '')) AS ends_sha256 FROM m GROUP BY depth, node),
kids AS (SELECT depth - 1 AS depth, up AS node, count(*) AS n_children FROM node WHERE depth > 0 GROUP BY 1, 2),
full_ AS MATERIALIZED (SELECT node.*, coalesce(n_children, 0) AS n_children FROM node LEFT JOIN kids USING (depth, node)),
own_path AS (SELECT m.conv_id, m.depth, m.node, f.depth AS d2, f.n_convs, f.n, f.n_children FROM m
  JOIN (SELECT * FROM full_) f ON f.conv_id = m.conv_id AND f.depth >= m.depth),
sums AS (SELECT depth, node, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum((n_convs - 1) * n) AS saved_tokens
  FROM own_path GROUP BY depth, node)
SELECT f.conv_id, f.depth, u.conv_id AS parent_conv_id, f.n_convs, f.n_children, s.n_leaves,
  CAST(s.saved_tokens AS BIGINT) AS saved_tokens, f.ends_sha256
FROM full_ f JOIN sums s USING (depth, node) LEFT JOIN full_ u ON u.depth = f.depth - 1 AND u.node = f.up AND f.depth > 0
"""


@query("op11_conversation_trie", _SQL)
def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rebuilt_trie(table(spark, sf_dir, "conversations"))
