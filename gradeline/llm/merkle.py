"""Merkle manifest of a dataset: a tree of digests per part, proofs of single rows, checks of altered rows.

Rows are leaves. At every level each node is joined by equality with the computed indices of its siblings, and the
nodes in slot zero of a run emit the parents. All runs of all trees take part in the same joins, so a tree that holds
most rows costs no task more than others. Leaves get their places from sorted ranges and running totals of the
ranges' counts; no tree is sorted or counted in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gradeline.llm.frames import lower_ascii
from gradeline.sources.tables import keep

#: Children of a node.
WIDTH = 8
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "array<struct<l: binary, r: binary>>"


def encoded(value: Column) -> Column:
    """``-`` for NULL, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(values: list[Column]) -> Column:
    return F.unhex(F.sha2(F.concat(*map(encoded, values)), 256))


def as_text(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def tree_key(column: Column) -> Column:
    """The part's value as a text that is never NULL and sorts bytewise, NULL first."""
    return F.coalesce(F.concat(F.lit("="), column.cast("string")), F.lit(""))


def placed(rows: DataFrame, tree: str, order: list[str], name: str) -> DataFrame:
    """``rows`` with ``idx``, their place in their tree, and ``size``, the tree's number of rows; kept.

    Rows are written in ranges of (tree, order), numbered within the range; a range's first number of a tree and the
    counts of the ranges before it give the place. Only (range, tree) counts, at most as many as ranges and trees
    together, pass through windows.
    """
    ranged = rows.repartitionByRange(tree, *order).sortWithinPartitions(tree, *order)
    numbered = keep(ranged.withColumn("number", F.monotonically_increasing_id()), name)
    part = F.shiftright("number", 33).alias("part")
    totals = numbered.groupBy(tree, part).agg(F.min("number").alias("lowest"), F.count("*").alias("n"))
    before = Window.partitionBy(tree).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = keep(totals.select(
        F.col(tree).alias("_tree"), F.col("part").alias("_part"), "lowest",
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"),
        F.sum("n").over(Window.partitionBy(tree)).alias("size"),
    ), f"{name}_offsets")
    same = (F.col(tree) == F.col("_tree")) & (F.shiftright("number", 33) == F.col("_part"))
    idx = F.col("number") - F.col("lowest") + F.col("earlier")
    return keep(
        numbered.join(offsets, same).select(*rows.columns, idx.cast("long").alias("idx"), F.col("size").cast("long").alias("size")),
        f"{name}_placed",
    )


def siblings(nodes: DataFrame, width: int) -> DataFrame:
    """(tree, idx, size, digest, l, r): the digests to the left and right of every node in its run.

    Each node looks up the places of its run, its own among them, by equality.
    """
    start = F.col("idx") - F.col("idx") % width
    asking = nodes.select("tree", "idx", "size", F.explode(F.sequence(start, F.least(start + width, F.col("size")) - 1)).alias("at"))
    found = asking.join(nodes.select("tree", F.col("idx").alias("at"), "digest"), ["tree", "at"])
    runs = found.groupBy("tree", "idx", "size").agg(F.sort_array(F.collect_list(F.struct("at", "digest"))).alias("run"))
    own = (F.col("idx") % width).cast("int")

    def joined(chosen: Column) -> Column:
        return F.aggregate(chosen, F.lit(b""), lambda acc, x: F.concat(acc, x["digest"]))

    return runs.select(
        "tree", "idx", "size", F.get("run", own)["digest"].alias("digest"),
        joined(F.slice("run", 1, own)).alias("l"), joined(F.slice("run", own + 2, width)).alias("r"),
    )


def parents(level: DataFrame, width: int) -> DataFrame:
    """The next level's nodes, from the nodes in slot zero."""
    digest = F.unhex(F.sha2(F.concat(as_text(F.col("digest")), as_text(F.col("r"))), 256))
    return level.where(F.col("idx") % width == 0).select(
        "tree", F.expr(f"idx div {width}").alias("idx"), F.ceil(F.col("size") / width).cast("long").alias("size"), digest.alias("digest")
    )


def grown(leaves: DataFrame, width: int, name: str) -> tuple[list[DataFrame], DataFrame]:
    """(levels, roots): every level's runs from the leaves up, and (tree, digest) of the trees' last nodes."""
    most = leaves.agg(F.max("size")).first()[0] or 0
    nodes, levels, roots = leaves.select("tree", "idx", "size", "digest"), [], []
    while most > 1:
        roots.append(nodes.where("size = 1"))
        levels.append(keep(siblings(nodes.where("size > 1"), width), f"{name}_level"))
        nodes, most = keep(parents(levels[-1], width), f"{name}_nodes"), -(-most // width)
    roots.append(nodes.where("size = 1"))
    whole = roots[0]
    for some in roots[1:]:
        whole = whole.unionByName(some)
    return levels, whole.select("tree", "digest")


def descended(nodes: DataFrame, levels: list[DataFrame], tops: DataFrame, width: int, name: str) -> DataFrame:
    """(tree, idx, path, *others of ``tops``) of the trees' first nodes, from (tree, path, *others) of their last ones.

    A node's path is its own run's digests and its parent's path.
    """
    others = [c for c in tops.columns if c not in ("tree", "path")]
    roots = tops.select("tree", F.lit(0).cast("long").alias("up"), F.lit(1).cast("long").alias("up_size"), "path", *others)

    def below(level: DataFrame, above: DataFrame) -> DataFrame:
        rows = level.select(
            "tree", "idx", "size", F.array(F.struct("l", "r")).alias("own"), F.expr(f"idx div {width}").alias("up"),
            F.ceil(F.col("size") / width).cast("long").alias("up_size"),
        )
        path = F.concat("own", "path").cast(PATH).alias("path")
        return rows.join(above, ["tree", "up", "up_size"]).select("tree", "idx", "size", path, *others)

    above = roots
    for level in reversed(levels[1:]):
        found = below(level, above).withColumnsRenamed({"idx": "up", "size": "up_size"})
        above = keep(found.unionByName(roots), f"{name}_paths")
    lone = nodes.where("size = 1").select("tree", "idx").join(roots.drop("up", "up_size"), "tree")
    if not levels:
        return lone.select("tree", "idx", "path", *others)
    return below(levels[0], above).drop("size").unionByName(lone.select("tree", "idx", "path", *others))


def manifest(
    docs: DataFrame, columns: list[str], part: str, order: str, altered: dict[str, Column] | None = None, width: int = WIDTH
) -> DataFrame:
    """A row for each row of ``docs``: its leaf, its place in its tree, its path and the root that the path leads to.

    A leaf is the digest of ``columns``, in that order, with NULL told apart from every value. Each value of ``part``,
    NULL being one, has a tree of its leaves by ``order`` (NULLs first); runs of ``width`` nodes become parents until one
    node is left, the subroot. Subroots by part (NULL first, bytewise) are the first nodes of the tree above them.
    ``altered`` gives columns the values to check against the manifest, NULL staying NULL.

    Returns (key, tree, idx, size, leaf, other, subroot, root, path, folded). ``key`` is the value of ``order``, ``tree``
    ``=`` and the part or the empty text for NULL, ``size`` the tree's number of leaves. Digests are binary, but for
    ``folded``, the root in hexadecimal that ``path`` makes of ``other``, the leaf of the altered row. ``path`` lists the joined
    digests to the left and right of the leaf and its ancestors. Rows that repeat a key follow each other by their digests;
    equal rows each have a place. An empty table gives an empty table. Columns of ``docs`` that are not named are not read.
    """
    values = {c: F.col(f"`{c}`") for c in columns}
    changed = {**values, **(altered or {})}
    rows = docs.select(
        tree_key(F.col(f"`{part}`")).alias("tree"), F.col(f"`{order}`").alias("key"),
        leaf_digest(list(values.values())).alias("digest"), leaf_digest([changed[c] for c in columns]).alias("other"),
    )
    leaves = placed(rows, "tree", ["key", "digest", "other"], "leaves")
    levels, subroots = grown(leaves, width, "tree")
    members = subroots.select(F.lit("").alias("tree"), F.col("tree").alias("member"), "digest")
    above = placed(members, "tree", ["member"], "subroots")
    upper, top = grown(above, width, "top")
    ended = top.select("tree", F.array().cast(PATH).alias("path"), F.col("digest").alias("root"))
    tops = above.join(descended(above, upper, ended, width, "top"), ["tree", "idx"]).select(
        F.col("member").alias("tree"), "path", "root", F.col("digest").alias("subroot")
    )
    found = descended(leaves, levels, keep(tops, "tops"), width, "tree")
    step = F.aggregate("path", as_text(F.col("other")), lambda acc, p: F.sha2(F.concat(as_text(p["l"]), acc, as_text(p["r"])), 256))
    return leaves.join(found, ["tree", "idx"]).select(
        "key", "tree", "idx", "size", F.col("digest").alias("leaf"), "other", "subroot", "root", "path", step.alias("folded")
    )


def proof_digest(path: Column) -> Column:
    """The digest of all sibling digests of a path, in hexadecimal."""
    return F.sha2(F.array_join(F.transform(path, lambda p: as_text(F.concat(p["l"], p["r"]))), ""), 256)


def manifest_report(docs: DataFrame) -> DataFrame:
    """One row per document; where 3 divides the CRC-32 of the id as text, its text is checked in lower case."""
    t, doc_id = F.col("text"), F.col("doc_id")
    tampered = F.when(F.crc32(doc_id.cast("string")) % 3 == 0, lower_ascii(t)).otherwise(t)
    found = manifest(docs.select(*COLUMNS), list(COLUMNS), "lang", "doc_id", {"text": tampered})
    root = as_text(F.col("root"))
    return found.select(
        F.col("key").alias("doc_id"), as_text(F.col("leaf")).alias("leaf"), as_text(F.col("subroot")).alias("subroot"),
        root.alias("root"), proof_digest(F.col("path")).alias("proof_sha256"), F.col("folded").alias("folded_root"),
        (F.col("folded") == root).alias("verified"),
    )


def _levels_sql(nodes: str, levels: int) -> str:
    """Common table expressions of the levels above ``nodes`` (tree, idx, size, digest) and of the siblings in each."""
    out = []
    for k in range(levels):
        frame = "OVER (PARTITION BY tree, idx // 8 ORDER BY idx ROWS BETWEEN"
        out.append(f"""
{nodes}{k}s AS (
  SELECT tree, idx, coalesce(string_agg(digest, '') {frame} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
    coalesce(string_agg(digest, '') {frame} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM {nodes}{k} WHERE size > 1),
{nodes}{k + 1} AS (
  SELECT tree, idx // 8 AS idx, (size + 7) // 8 AS size, sha256(string_agg(digest, '' ORDER BY idx)) AS digest
  FROM {nodes}{k} WHERE size > 1 GROUP BY ALL)""")
    return ",".join(out)


def _folds_sql(nodes: str, start: str, levels: int) -> str:
    """Common table expressions that carry (tree, idx, size, proof, folded) of ``start`` up, level by level."""
    out = []
    for k in range(levels):
        before = start if k == 0 else f"{nodes}{k - 1}p"
        out.append(f"""
{nodes}{k}p AS (
  SELECT p.* REPLACE (
    CASE WHEN size > 1 THEN p.idx // 8 ELSE p.idx END AS idx, (size + 7) // 8 AS size,
    proof || coalesce(l || r, '') AS proof, CASE WHEN size > 1 THEN sha256(l || folded || r) ELSE folded END AS folded)
  FROM {before} p LEFT JOIN {nodes}{k}s s ON p.tree = s.tree AND p.idx = s.idx AND p.size > 1)""")
    return ",".join(out)


def _encoded_sql(value: str) -> str:
    return f"coalesce(strlen(CAST({value} AS VARCHAR)) || ':' || CAST({value} AS VARCHAR), '-')"


#: The levels that the SQL spells out: enough for 8 ** 10 leaves in a language, 8 ** 4 languages.
SQL_LEVELS, SQL_UPPER = 10, 4
REPORT_SQL = f"""
WITH RECURSIVE steps AS (
  SELECT range AS byte, range AS value, 0 AS step FROM range(256)
  UNION ALL
  SELECT byte, CASE WHEN value & 1 = 1 THEN xor(value >> 1, 3988292384) ELSE value >> 1 END, step + 1 FROM steps WHERE step < 8),
crc AS (SELECT list(value ORDER BY byte) AS t FROM steps WHERE step = 8),
checked AS (
  SELECT d.*, CASE WHEN xor(4294967295, list_reduce(
      list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)),
      lambda c, x: xor(c >> 8, t[1 + xor(c & 255, x)]), 4294967295)) % 3 = 0
    THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END AS other_text
  FROM documents d, crc),
leaves AS (
  SELECT doc_id, coalesce('=' || lang, '') AS tree,
    sha256({" || ".join(_encoded_sql(c) for c in COLUMNS)}) AS digest,
    sha256({" || ".join(_encoded_sql(c) for c in (*COLUMNS[:-1], "other_text"))}) AS other
  FROM checked),
n0 AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, digest, other) - 1 AS idx,
    count(*) OVER (PARTITION BY tree) AS size FROM leaves),{_levels_sql("n", SQL_LEVELS)},
u0 AS (
  SELECT '' AS tree, tree AS member, digest, row_number() OVER (ORDER BY tree) - 1 AS idx, count(*) OVER () AS size
  FROM ({" UNION ALL ".join(f"SELECT tree, digest FROM n{k} WHERE size = 1" for k in range(SQL_LEVELS + 1))})),{_levels_sql("u", SQL_UPPER)},
top AS ({" UNION ALL ".join(f"SELECT digest AS root FROM u{k} WHERE size = 1" for k in range(SQL_UPPER + 1))}),
starts AS (SELECT doc_id, tree, idx, size, digest AS leaf, '' AS proof, other AS folded FROM n0),{_folds_sql("n", "starts", SQL_LEVELS)},
middle AS (
  SELECT p.doc_id, p.leaf, p.proof, p.folded, u.tree, u.idx, u.size, u.digest AS subroot
  FROM n{SQL_LEVELS - 1}p p JOIN u0 u ON p.tree = u.member),{_folds_sql("u", "middle", SQL_UPPER)}
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = root AS verified
FROM u{SQL_UPPER - 1}p, top"""
