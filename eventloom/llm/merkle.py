r"""Merkle manifest of a table, by concatenated level strings.

A leaf is the hash of a row's columns.  Leaves of a group (``lang``) ascend by id; every
``FANOUT`` consecutive nodes of a level become the hash of their hex texts, until one is
left, the subroot.  The subroots, ordered by group, give the root in the same way.

``BLOCK`` aligned leaves meet in one row, where each level is one string of hex digests:
a parent is the hash of a fixed-width substring, and the siblings of a node are the
substrings left and right of it.  As the block is a power of the fan-out, no run of
siblings crosses blocks; the blocks' top nodes are the leaves of the next round, until
each group has one node.  Paths then go down again, a block at a time: every round joins
one row per block, never one per leaf.  (The strings are kept as bytes, whose substrings
take constant time.)

Leaves get their position from one distributed sort by group and id and the counts of its
partitions, so a group with a third of all rows is cut like any other; a block holds at
most ``BLOCK`` leaves whatever the group's size.  Texts are hashed in the scan and go no
further.

Defined results: a null column is hashed as ``-``, an empty text as ``0:``; null group is
a group of its own and the first, null id comes first; rows with one id are ordered by
their leaf, and equal rows have equal leaves, each at a place of its own; one row alone is
leaf, subroot and root; an empty table gives no rows; further columns take no part.  The
caller's columns come back in one struct, so no name can clash.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventloom.llm.common import UPPER, id_text
from eventloom.session import stage_table

FANOUT = 8
LEVELS = 3
BLOCK = FANOUT ** LEVELS
HEX = 64
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
SEGMENT = "array<struct<before:string,after:string>>"


def _encoded(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(columns: Sequence[Column]) -> Column:
    """The digest of a row's values, each with its byte length in front."""
    return F.sha2(F.concat(*[_encoded(c) for c in columns]), 256)


def fold(leaf: Column, path: Column) -> Column:
    """The root that ``leaf`` has with the siblings in ``path``."""
    return F.aggregate(path, leaf, lambda node, s: F.sha2(F.concat(s["before"], node, s["after"]), 256))


def siblings(path: Column) -> Column:
    """All siblings on the way to the root, one after the other."""
    return F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["after"])), "")


def _positioned(rows: DataFrame) -> DataFrame:
    """``key, pos, n, node, row`` of ``key, at, node, row``: the place within the key and
    the key's size.

    The order is a distributed sort over all columns and a row number, so that not even
    equal rows are bound to one partition; only counts per partition and key are summed.
    """
    given = stage_table(rows.withColumn("seq", F.monotonically_increasing_id()), "merkle-leaves")
    part = F.shiftright("id", 33)
    ordered = stage_table(
        given.orderBy("key", F.col("at").asc_nulls_first(), "node", "seq")
        .select("key", "node", "row", F.monotonically_increasing_id().alias("id")),
        "merkle-order",
    ).withColumn("part", part)
    runs = ordered.groupBy("key", "part").agg(F.min("id").alias("first"), F.count("*").alias("size"))
    by_key = Window.partitionBy("key")
    before = by_key.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = runs.select(
        "key", "part", F.sum("size").over(by_key).alias("n"),
        (F.coalesce(F.sum("size").over(before), F.lit(0)) - F.col("first")).alias("shift"),
    )
    return ordered.join(starts, ["key", "part"]).select(
        "key", (F.col("id") + F.col("shift")).alias("pos"), "n", "node", "row"
    )


def _parents(level: Column) -> Column:
    """The level above, as one string of digests."""
    runs = F.ceil(F.octet_length(level) / (FANOUT * HEX)).cast("int")
    return F.array_join(F.transform(
        F.sequence(F.lit(0), runs - 1),
        lambda i: F.sha2(F.substring(level, i * (FANOUT * HEX) + 1, F.lit(FANOUT * HEX)), 256),
    ), "").cast("binary")


def _blocks(nodes: DataFrame) -> DataFrame:
    """One row per aligned block with its levels; ``top`` is the node it ends in."""
    depth = reduce(lambda rest, k: F.when(F.col("n") <= FANOUT ** k, k).otherwise(rest), range(LEVELS - 1, -1, -1), F.lit(LEVELS))
    blocks = nodes.groupBy("key", F.expr(f"pos div {BLOCK}").alias("block")).agg(
        F.first("n").alias("n"), F.sort_array(F.collect_list(F.struct("pos", "node", "row"))).alias("nodes")
    ).withColumn("depth", depth)
    blocks = blocks.withColumn("l0", F.array_join(F.transform("nodes", lambda x: x["node"]), "").cast("binary"))
    for k in range(1, LEVELS + 1):
        blocks = blocks.withColumn(f"l{k}", F.when(F.col("depth") >= k, _parents(F.col(f"l{k - 1}"))))
    tops = F.coalesce(*[F.col(f"l{k}") for k in range(LEVELS, -1, -1)]).cast("string")
    return stage_table(blocks.withColumn("top", tops).drop(f"l{LEVELS}"), "merkle-blocks")


def _up(rows: DataFrame) -> list[DataFrame]:
    """The blocks of every round, the last of which has one block per key.

    The driver reads one number: the size of the largest key, which gives the rounds.
    """
    nodes = _positioned(rows)
    rounds = [_blocks(nodes)]
    largest = rounds[0].agg(F.max("n")).first()[0] or 0
    while largest > BLOCK:
        largest = -(-largest // BLOCK)
        below = rounds[-1]
        rounds.append(_blocks(below.select(
            "key", F.col("block").alias("pos"), F.ceil(F.col("n") / BLOCK).cast("bigint").alias("n"),
            F.col("top").alias("node"), F.lit(None).cast("int").alias("row"),
        )))
    return rounds


def _segments(i: Column) -> Column:
    """The siblings of the block's node ``i``, one segment for each level of the block."""
    found = []
    for k in range(LEVELS):
        level, at = F.col(f"l{k}"), F.floor(i / FANOUT ** k).cast("int")
        run = F.floor(at / FANOUT).cast("int") * FANOUT
        found.append(F.struct(
            F.substring(level, run * HEX + 1, (at - run) * HEX).cast("string").alias("before"),
            F.substring(level, (at + 1) * HEX + 1, (run + FANOUT - 1 - at) * HEX).cast("string").alias("after"),
        ))
    return F.slice(F.array(*found), F.lit(1), F.col("depth"))


def _down(rounds: list[DataFrame], above: DataFrame) -> DataFrame:
    """``key, node, row, path`` and what ``above`` has besides, for every leaf.

    ``above`` has the path of each key's last node to the root.
    """
    carried = [c for c in above.columns if c not in ("key", "pos", "path")]
    above = above.withColumn("pos", F.lit(0).cast("bigint"))
    for blocks in reversed(rounds):
        here = blocks.join(above.withColumnRenamed("pos", "block"), ["key", "block"])
        each = F.transform("nodes", lambda x, i: F.struct(
            x["pos"].alias("pos"), x["node"].alias("node"), x["row"].alias("row"),
            F.concat(_segments(i), F.col("path")).alias("path"),
        ))
        above = here.select("key", *carried, F.explode(each).alias("x")).select("key", *carried, "x.*")
    return above


def build_manifest(rows: DataFrame, leaf: str = "leaf", group: str = "lang", order: str = "doc_id") -> DataFrame:
    """``leaf, path, subroot, root`` and the given columns as struct ``row``, for every row.

    ``path`` is the list of sibling segments from the leaf to the root; :func:`fold` of
    leaf and path is the root.
    """
    value = F.col(group).cast("string")
    # A null group sorts before every other: "-" is less than "=".
    key = F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), value))
    rounds = _up(rows.select(
        key.alias("key"), F.col(order).alias("at"), F.col(leaf).alias("node"), F.struct(*rows.columns).alias("row")
    ))
    subroots = rounds[-1].select(
        F.lit("").alias("key"), F.col("key").alias("at"), F.col("top").alias("node"), F.col("key").alias("row")
    )
    over = _up(subroots)
    start = over[-1].select("key", F.array().cast(SEGMENT).alias("path"), F.col("top").alias("root"))
    tops = _down(over, start).select(F.col("row").alias("key"), "path", F.col("node").alias("subroot"), "root")
    return _down(rounds, stage_table(tops, "merkle-roots")).select("row", F.col("node").alias("leaf"), "path", "subroot", "root")


def tampered_text(text: Column) -> Column:
    return F.translate(text, UPPER, UPPER.lower())


def manifest_digest(docs: DataFrame) -> DataFrame:
    """The manifest of ``docs``, and whether each row, some of them tampered with, verifies."""
    own = [F.col(c) for c in COLUMNS]
    changed = [tampered_text(F.col(c)) if c == "text" else F.col(c) for c in COLUMNS]
    leaf = leaf_hash(own)
    shown = F.when(F.crc32(id_text().cast("binary")) % 3 == 0, leaf_hash(changed)).otherwise(leaf)
    built = build_manifest(docs.select("doc_id", "lang", leaf.alias("leaf"), shown.alias("shown")))
    read = built.select(
        "row.doc_id", "leaf", "subroot", "root", F.sha2(siblings(F.col("path")), 256).alias("proof_sha256"),
        fold(F.col("row.shown"), F.col("path")).alias("folded_root"),
    )
    return read.withColumn("verified", F.col("folded_root") == F.col("root"))


BITS = FANOUT.bit_length() - 1

SQL = f"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS rid, *, CASE WHEN lang IS NULL THEN '-' ELSE '=' || lang END AS key FROM documents),
enc AS (
  SELECT rid, key, doc_id, coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id::VARCHAR, '-') || coalesce(strlen(source) || ':' || source, '-')
    || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars::VARCHAR, '-') AS head,
    text, translate(text, '{UPPER}', '{UPPER.lower()}') AS lowered,
    xor(list_reduce([4294967295] || flatten(list_transform(range(1, strlen(doc_id::VARCHAR) + 1),
      lambda i: [ascii(substr(doc_id::VARCHAR, i, 1))::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1])),
      lambda c, b: CASE WHEN b >= 0 THEN xor(c, b) WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END), 4294967295) AS crc
  FROM d),
leaves AS (
  SELECT rid, key, doc_id, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    CASE WHEN crc % 3 = 0 THEN sha256(head || coalesce(strlen(lowered) || ':' || lowered, '-'))
    ELSE sha256(head || coalesce(strlen(text) || ':' || text, '-')) END AS shown FROM enc),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY key ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY key) AS n
  FROM leaves),
levels AS (
  SELECT key, 0 AS level, pos, leaf AS node, n FROM placed
  UNION ALL
  SELECT key, level + 1, pos // {FANOUT}, sha256(string_agg(node, '' ORDER BY pos)), (n + {FANOUT - 1}) // {FANOUT} FROM levels WHERE n > 1
  GROUP BY key, level, pos // {FANOUT}, n),
subroots AS (SELECT key, node AS subroot, row_number() OVER (ORDER BY key) - 1 AS pos, count(*) OVER () AS n FROM levels WHERE n = 1),
upper AS (
  SELECT 0 AS level, pos, subroot AS node, n FROM subroots
  UNION ALL
  SELECT level + 1, pos // {FANOUT}, sha256(string_agg(node, '' ORDER BY pos)), (n + {FANOUT - 1}) // {FANOUT} FROM upper WHERE n > 1
  GROUP BY level, pos // {FANOUT}, n),
steps AS (
  SELECT p.rid, l.level, coalesce(string_agg(l.node, '' ORDER BY l.pos) FILTER (WHERE l.pos < (p.pos >> ({BITS} * l.level))), '') AS before,
    coalesce(string_agg(l.node, '' ORDER BY l.pos) FILTER (WHERE l.pos > (p.pos >> ({BITS} * l.level))), '') AS after
  FROM placed p JOIN levels l ON p.key = l.key AND l.n > 1 AND (p.pos >> ({BITS} * (l.level + 1))) = (l.pos >> {BITS}) GROUP BY ALL
  UNION ALL
  SELECT p.rid, 100 + u.level, coalesce(string_agg(u.node, '' ORDER BY u.pos) FILTER (WHERE u.pos < (s.pos >> ({BITS} * u.level))), ''),
    coalesce(string_agg(u.node, '' ORDER BY u.pos) FILTER (WHERE u.pos > (s.pos >> ({BITS} * u.level))), '')
  FROM placed p JOIN subroots s ON p.key = s.key JOIN upper u ON u.n > 1 AND (s.pos >> ({BITS} * (u.level + 1))) = (u.pos >> {BITS}) GROUP BY ALL),
numbered AS (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY level) AS step FROM steps),
folded AS (
  SELECT rid, 0::BIGINT AS step, shown AS node FROM placed
  UNION ALL
  SELECT f.rid, n.step, sha256(n.before || f.node || n.after) FROM folded f JOIN numbered n ON f.rid = n.rid AND n.step = f.step + 1),
proofs AS (SELECT rid, sha256(string_agg(before || after, '' ORDER BY level)) AS proof FROM steps GROUP BY rid),
ends AS (SELECT rid, arg_max(node, step) AS folded_root FROM folded GROUP BY rid)
SELECT p.doc_id, p.leaf, s.subroot, u.node AS root, coalesce(proof, sha256('')) AS proof_sha256, folded_root, folded_root = u.node AS verified
FROM placed p JOIN subroots s USING (key) JOIN upper u ON u.n = 1 JOIN ends USING (rid) LEFT JOIN proofs USING (rid)
"""
