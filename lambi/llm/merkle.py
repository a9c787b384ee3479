"""Merkle manifest of a dataset with a proof for every row (operator 13).

The tree is worked through in the order of its labels, children before parents (time-forward
processing). What one task works through is a block of `FAN` ** 2 neighbours, with a priority queue of
digests that are on their way to a parent; what leaves a block is a row of a table, keyed by its
place in the next layer, and Spark's sorted shuffle is the queue's external part. The sweep back
delivers to each node, parents first, the siblings of all its ancestors.
"""

from __future__ import annotations

import heapq
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lambi.llm.shared import cut
from lambi.llm.spelling import CRC_TABLE, LOWER, UPPER, crc_sql, lower_ascii
from lambi.operators.running import running

FAN = 16
#: Levels that one task works through, and the neighbours that meet there.
LEVELS = 2
BLOCK = FAN**LEVELS


def _piece(value: Column) -> Column:
    return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value))


def _leaf(columns: list[Column]) -> Column:
    return F.sha2(F.concat(*map(_piece, columns)), 256)


def _depth(n: int) -> int:
    """Levels above n neighbours."""
    out = 0
    while n > 1:
        n, out = -(-n // FAN), out + 1
    return out


def _h(*digests: str) -> str:
    return sha256("".join(digests).encode()).hexdigest()


def rise(digests: list[str], levels: int) -> tuple[str, dict[tuple[int, int], list[str]]]:
    """The digest of a block and, by (last leaf below, level), what each inner node got.

    A message in the queue is (label of the parent, its place, digest); a node's turn comes when the
    next leaf is behind it, and then all its messages are in front of the queue.
    """
    queue: list[tuple[tuple[int, int], int, str]] = []
    got: dict[tuple[int, int], list[str]] = {}
    n, top = len(digests), digests[0]

    def send(place: int, level: int, digest: str) -> None:
        last = min((place // FAN + 1) * FAN ** (level + 1), n) - 1
        heapq.heappush(queue, ((last, level + 1), place, digest))

    for leaf in range(n + 1):
        while queue and queue[0][0] < (leaf, 0):
            label = queue[0][0]
            got[label] = []
            while queue and queue[0][0] == label:
                _, place, digest = heapq.heappop(queue)
                got[label].append(digest)
            top = _h(*got[label])
            if label[1] < levels:
                send(place // FAN, label[1], top)
        if leaf < n and levels:
            send(leaf, 0, digests[leaf])
    return top, got


Path = list[tuple[str, str]]


def fall(n: int, levels: int, got: dict[tuple[int, int], list[str]], path: Path) -> list[Path]:
    """The path of each leaf of a block whose own path is given: siblings before and behind, from the
    leaf's level on to the root's. Nodes take their turn in the reverse order of their labels."""
    if not levels:
        return [path]
    out: list[Path] = [[]] * n
    queue: list[tuple[tuple[int, int], int, Path]] = [((-(n - 1), -levels), 0, path)]
    while queue:
        (last, level), place, path = heapq.heappop(queue)
        children = got[-last, -level]
        for i, _ in enumerate(children):
            own, at = [("".join(children[:i]), "".join(children[i + 1 :])), *path], place * FAN + i
            if level == -1:
                out[at] = own
            else:
                below = min((at + 1) * FAN ** (-level - 1), n) - 1
                heapq.heappush(queue, ((-below, level + 1), at, own))
    return out


def _rise_block(key: tuple, block: pa.Table) -> pa.Table:
    block = block.sort_by("number")
    n = block["size"][0].as_py()
    levels = min(LEVELS, _depth(n))
    digest, _ = rise(block["digest"].to_pylist(), levels)
    return pa.table({"tree": [key[0].as_py()], "number": [key[1].as_py()], "size": [-(-n // FAN**levels)], "digest": [digest]})


NODE = "tree string, number long, size long, digest string"
PATHS = "tree string, number long, subroot string, root string, path array<struct<before:string,after:string>>"
PROOFS = "digest string, subroot string, root string, proof_sha256 string, folded_root string"
_PAIRS = pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))


def _blocks(df: DataFrame):
    return df.withColumn("block", F.floor(F.col("number") / BLOCK)).groupBy("tree", "block")


def rise_all(nodes: DataFrame) -> list[DataFrame]:
    """Layers of all trees, each two levels above the one before, up to one node a tree."""
    layers = [nodes]
    while True:
        up = cut(_blocks(layers[-1].select("tree", "number", "size", "digest")).applyInArrow(_rise_block, NODE))
        layers.append(up)
        if (up.agg(F.max("size")).first()[0] or 1) == 1:
            return layers


def _paths_of(block: pa.Table, above: pa.Table) -> list[Path]:
    n = block["size"][0].as_py()
    levels = min(LEVELS, _depth(n))
    _, got = rise(block["digest"].to_pylist(), levels)
    return fall(len(block), levels, got, [(x["before"], x["after"]) for x in above["path"][0].as_py()])


def _fall_block(key: tuple, block: pa.Table, above: pa.Table) -> pa.Table:
    block = block.sort_by("number")
    paths = [[{"before": b, "after": a} for b, a in p] for p in _paths_of(block, above)]
    same = lambda c: pa.array([above[c][0].as_py()] * len(block), pa.string())
    return pa.table({"tree": block["tree"], "number": block["number"], "subroot": same("subroot"), "root": same("root"), "path": pa.array(paths, _PAIRS)})


def _prove_block(key: tuple, block: pa.Table, above: pa.Table) -> pa.Table:
    block = block.sort_by("number")
    proofs, folded = [], []
    for own, path in zip(block["changed"].to_pylist(), _paths_of(block, above)):
        proofs.append(_h(*(x for pair in path for x in pair)))
        for before, after in path:
            own = _h(before, own, after)
        folded.append(own)
    same = lambda c: pa.array([above[c][0].as_py()] * len(block), pa.string())
    return pa.table({"id": block["id"], "digest": block["digest"], "subroot": same("subroot"), "root": same("root"), "proof_sha256": proofs, "folded_root": folded})


def fall_all(layers: list[DataFrame], paths: DataFrame, proofs: bool = False) -> DataFrame:
    """Paths (see `PATHS`) of the first layer's nodes, from those of the trees' roots; or the proofs of
    its rows, whose paths are never written then."""
    for k in reversed(range(len(layers) - 1)):
        above = paths.withColumn("block", F.col("number")).select("tree", "block", "subroot", "root", "path").groupBy("tree", "block")
        if proofs and not k:
            schema = StructType([layers[0].schema["id"], *StructType.fromDDL(PROOFS).fields])
            return _blocks(layers[0]).cogroup(above).applyInArrow(_prove_block, schema)
        paths = cut(_blocks(layers[k].select("tree", "number", "size", "digest")).cogroup(above).applyInArrow(_fall_block, PATHS))
    return paths


def manifest(docs: DataFrame, id_col: str = "doc_id", group_col: str = "source", value_cols: tuple[str, ...] = ("lang", "n_chars", "text"), tampered: Column | None = None, text_col: str = "text") -> DataFrame:
    """Digest of every row, roots of its group and of the whole, and the check of its proof.

    A leaf is the sha256 of id, group and values, each as byte count, colon and value (null: ``-``).
    Leaves of a group stand by id (null first; rows of one id by digest); every 16 neighbours become
    one node until one is left, the subroot; subroots by group (null first) likewise become the root.
    Where `tampered` holds (default: nowhere), the leaf to be checked has its text in lower case
    (A-Z). Columns: id, leaf, subroot, root, proof_sha256 (of the siblings, from the leaf's level on),
    folded_root (from the leaf to be checked and the siblings), verified (equals root).

    Repeated rows are leaves of their own, and a null id, a null group or an empty text is a value like
    another. Texts of any length are hashed whole, once (twice where tampered with). Further columns are
    not read, so they can't clash. An empty table gives an empty result. A group of any size is spread:
    a task holds blocks of 256 neighbours, and paths of a block's parent, not of each row, are written.
    """
    names = [id_col, group_col, *value_cols]
    values = [F.col(c).cast("string") for c in names]
    changed = [lower_ascii(v) if c == text_col else v for c, v in zip(names, values)]
    leaf = _leaf(values)
    # group keys without nulls, in the same order
    tree = F.coalesce(F.concat(F.lit("="), F.col(group_col).cast("string")), F.lit("-"))
    hashed = docs.select(F.col(id_col).alias("id"), tree.alias("tree"), leaf.alias("digest"), (F.lit(None).cast("string") if tampered is None else F.when(tampered, _leaf(changed))).alias("other"))
    hashed = cut(hashed.select("id", "tree", "digest", F.coalesce("other", "digest").alias("changed")))
    leaves = cut(running(hashed, ["id", "digest"], ["tree"], keep=cut))
    layers = rise_all(leaves)
    subroots = layers[-1].select("tree", "digest")
    top = cut(running(subroots, ["tree"], keep=cut).withColumn("of", F.col("tree")).withColumn("tree", F.lit("")))
    above = rise_all(top)
    root = above[-1].select("tree", "number", F.lit("").alias("subroot"), F.col("digest").alias("root"), F.array().cast("array<struct<before:string,after:string>>").alias("path"))
    down = fall_all(above, root).select(F.col("number").alias("_n"), "root", "path")
    paths = top.join(down, F.col("number") == F.col("_n")).select(F.col("of").alias("tree"), F.lit(0).cast("long").alias("number"), F.col("digest").alias("subroot"), "root", "path")
    proofs = fall_all(layers, cut(paths), proofs=True)
    return proofs.select(F.col("id").alias(id_col), F.col("digest").alias("leaf"), "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 13 over all documents; where 5 divides the crc32 of the id, the text is tampered with."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return manifest(docs, tampered=F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0)


def _sql() -> str:
    lower = f"translate(text, '{UPPER}', '{LOWER}')"
    piece = lambda c: f"CASE WHEN {c} IS NULL THEN '-' ELSE concat(octet_length(encode({c}::VARCHAR)), ':', {c}) END"
    hashed = lambda text: "sha256(concat(" + ", ".join(map(piece, ("doc_id", "source", "lang", "n_chars", text))) + "))"
    run = f"PARTITION BY tree, i // {FAN} ORDER BY i ROWS BETWEEN"

    def layers(name: str, depth: int) -> list[str]:
        """name_0 has tree, i and d; name_k its k-th level, with the siblings of each node."""
        out = []
        for k in range(depth):
            near = lambda rows: f"coalesce(string_agg(d, '') OVER ({run} {rows}), '')"
            before, after = near("UNBOUNDED PRECEDING AND 1 PRECEDING"), near("1 FOLLOWING AND UNBOUNDED FOLLOWING")
            out.append(f"{name}s_{k} AS MATERIALIZED (SELECT *, {before} AS a, {after} AS b, count(*) OVER (PARTITION BY tree) AS n FROM {name}_{k})")
            out.append(f"""{name}_{k + 1} AS MATERIALIZED (SELECT tree, i // {FAN} AS i, CASE WHEN n = 1 THEN min(d) ELSE sha256(string_agg(d, '' ORDER BY i)) END AS d FROM {name}s_{k} GROUP BY tree, i // {FAN}, n)""")
        return out

    low, high = 5, 3
    steps = [f"l{k}" for k in range(low)] + [f"t{k}" for k in range(high)]
    fold = "changed"
    for s in steps:
        fold = f"(CASE WHEN {s}.n = 1 THEN {fold} ELSE sha256(concat({s}.a, {fold}, {s}.b)) END)"
    joins = [f"JOIN Ls_{k} l{k} ON l{k}.tree = x.tree AND l{k}.i = x.i // {FAN**k}" for k in range(low)]
    joins += [f"JOIN Ts_{k} t{k} ON t{k}.i = p.i // {FAN**k}" for k in range(high)]
    return f"""WITH crc AS ({CRC_TABLE}),
x AS MATERIALIZED (SELECT doc_id, coalesce(concat('=', source), '-') AS tree, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, {hashed("text")}) - 1 AS i, {hashed("text")} AS d,
      CASE WHEN {crc_sql("doc_id::VARCHAR")} % 5 = 0 THEN {hashed(lower)} ELSE {hashed("text")} END AS changed FROM documents, crc),
L_0 AS (SELECT tree, i, d FROM x), {", ".join(layers("L", low))},
p AS MATERIALIZED (SELECT tree, d AS subroot, row_number() OVER (ORDER BY encode(tree)) - 1 AS i FROM L_{low}),
T_0 AS (SELECT '' AS tree, i, subroot AS d FROM p), {", ".join(layers("T", high))}
SELECT doc_id, x.d AS leaf, subroot, r.d AS root, sha256(concat({", ".join(f"{s}.a, {s}.b" for s in steps)})) AS proof_sha256, {fold} AS folded_root, folded_root = root AS verified
FROM x JOIN p ON p.tree = x.tree {" ".join(joins)}, T_{high} r"""


ORACLE = _sql()
