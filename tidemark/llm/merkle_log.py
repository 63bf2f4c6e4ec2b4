"""Merkle manifest of a table as a postorder append log.

Every row is a leaf. The leaves of one group stand in order, runs of ``ARITY``
nodes become their parent (the last run may be shorter, even of one) until one
node is left, the group's top; the tops, in order of the groups' names, are the
leaves of one more tree, whose top is the root.

A tree's nodes are numbered in postorder: a node is appended as soon as its last
child is. Nodes that end before leaf i fill whole subtrees, so leaf i stands at
``sum(i // ARITY**l)`` over the levels l, and a node of level L just L places
after its last leaf (``position``); no node has to be looked up to know where
another one stands.

1. Leaves are dealt by ranges of (group, order), packed, and cut into aligned
   blocks of ``BLOCK`` leaves, whatever range they came from. A group of any size
   is thus many blocks.
2. A builder takes a block and appends its nodes in completion order. A block's
   entries follow one another in the group's log.
3. The blocks' tops are the leaves of the next tier of builders, and so on.
4. Proofs come down the tiers: a block's siblings above are extracted once for
   the block, those inside it by position from the block's entries.

A proof is, level by level from the leaf up, one byte for the place in the run,
one for the run's length, and the siblings' digests from left to right.

NULL groups come first, then names bytewise. Leaves of a group ascend by their
order columns (NULL first) and then by digest; rows repeated are leaves of their
own. An empty table has neither leaves nor a root. Columns that are not named
are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.runs import cut_runs, pack_runs
from tidemark.session import scratch_path

ARITY = 8
HEIGHT = 4                                    # levels that one builder makes
BLOCK = ARITY ** HEIGHT
_ROW = np.dtype([("id", "<i8"), ("flags", "u1"), ("leaf", "V32"), ("claim", "V32")])
HAS_ID, HAS_CLAIM = 1, 2
LOG = "tier int, grp string, block long, n long, start long, ids binary, nodes binary"


def digest(*fields: Column) -> Column:
    """The SHA-256 (32 bytes) of fields in order: ``-`` for NULL, else the
    number of UTF-8 bytes, a colon and the text."""
    text = [f.cast("string") for f in fields]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in text]
    return F.unhex(F.sha2(F.concat(*parts).cast("binary"), 256))


def levels(n: int) -> int:
    """Levels above the leaves of a tree with n leaves."""
    up = 0
    while n > 1:
        n, up = -(-n // ARITY), up + 1
    return up


def position(level: int, j, n: int, height: int | None = None):
    """The place in the postorder log of node j of a level of a tree with n leaves (j may be an array)."""
    end = np.minimum((np.asarray(j, np.int64) + 1) * ARITY ** level, n) - 1
    return sum(end // ARITY ** x for x in range((levels(n) if height is None else height) + 1)) + level


def hex_digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _height(n: int) -> int:
    return HEIGHT if n > BLOCK else levels(n)


def append_block(leaves: list[str], height: int) -> list[str]:
    """The nodes over a block's leaves (hex digests) in completion order."""
    log: list[str] = []
    open_: list[list[str]] = [[] for _ in range(height + 1)]           # nodes of each level that wait for their parent
    for i, leaf in enumerate(leaves):
        node, ends = leaf, i == len(leaves) - 1
        for level in range(height + 1):
            log.append(node)
            open_[level].append(node)
            if level == height or not (ends or len(open_[level]) == ARITY):
                break
            node, open_[level] = hex_digest("".join(open_[level])), []
    return log


def block_levels(nodes: bytes, n: int) -> list[list[str]]:
    """The nodes of each level of a block with n leaves, taken from its log by position."""
    text, height = nodes.hex(), 0
    height = next(h for h in range(HEIGHT + 1) if position(h, 0 if h == 0 else -(-n // ARITY ** h) - 1, n, h) == len(nodes) // 32 - 1)
    out = []
    for level in range(height + 1):
        at = position(level, np.arange(-(-n // ARITY ** level)), n, height)
        out.append([text[64 * p:64 * p + 64] for p in at.tolist()])
    return out


def fold(leaf: str, proof: bytes) -> str:
    """The top that a leaf's digest and a proof lead to."""
    at = 0
    while at < len(proof):
        place, size = proof[at], proof[at + 1]
        run = proof[at + 2:at + 2 + 32 * (size - 1)].hex()
        leaf = hex_digest(run[:64 * place] + leaf + run[64 * place:])
        at += 2 + 32 * (size - 1)
    return leaf


def siblings_text(proof: bytes) -> str:
    """A proof's siblings as hex text, one after another."""
    at, out = 0, []
    while at < len(proof):
        end = at + 2 + 32 * (proof[at + 1] - 1)
        out.append(proof[at + 2:end].hex())
        at = end
    return "".join(out)


def _tier(rows: DataFrame, tier: int, path: str) -> DataFrame:
    """Builders over ``grp, block, n, data``: records ``_ROW`` in the lowest tier, digests in the others."""
    def build(batches):
        for batch in batches:
            out = {c.split()[0]: [] for c in LOG.split(", ")}
            for i in range(batch.num_rows):
                grp, block, n, data = (batch.column(j)[i].as_py() for j in range(4))
                if tier == 0:
                    held = np.frombuffer(data, _ROW)
                    leaves = [x.tobytes().hex() for x in held["leaf"]]
                else:
                    text = data.hex()
                    leaves = [text[k:k + 64] for k in range(0, len(text), 64)]
                log = append_block(leaves, _height(n))
                for c, x in zip(out, (tier, grp, block, n, int(position(0, block * BLOCK, n)), data if tier == 0 else None, bytes.fromhex("".join(log)))):
                    out[c].append(x)
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema([("tier", pa.int32()), ("grp", pa.string()), ("block", pa.int64()), ("n", pa.int64()),
                                                                    ("start", pa.int64()), ("ids", pa.binary()), ("nodes", pa.binary())]))

    at = f"{path}/tier={tier}"
    rows.select("grp", "block", "n", "data").mapInArrow(build, LOG).drop("tier").write.parquet(at)
    return rows.sparkSession.read.parquet(at)


def append_log(leaves: DataFrame, order: list[str], path: str) -> list[DataFrame]:
    """Write the logs of all groups under ``path`` and return its tiers, lowest
    first. ``leaves``: ``grp`` (string, not NULL), the ``order`` columns, ``id``
    (long), ``leaf`` (32 bytes) and ``claim`` (another digest for the leaf's
    place that is to be checked, or NULL)."""
    def record(batch):
        col = {c: batch.column(i) for i, c in enumerate(batch.schema.names)}
        x = np.zeros(batch.num_rows, _ROW)
        has_id, has_claim = (col[c].is_valid().to_numpy(zero_copy_only=False) for c in ("id", "claim"))
        x["id"] = col["id"].fill_null(0).to_numpy()
        x["flags"] = has_id * HAS_ID + has_claim * HAS_CLAIM
        x["leaf"] = np.frombuffer(b"".join(col["leaf"].to_pylist()), "V32")
        x["claim"] = np.frombuffer(b"".join(c or bytes(32) for c in col["claim"].to_pylist()), "V32")
        return x.view(np.uint8)

    by = ["grp", *order, "leaf"]
    pieces = pack_runs(leaves.select("grp", *dict.fromkeys([*order, "id", "leaf", "claim"])), list(dict.fromkeys(by)), record, _ROW.itemsize, BLOCK, "merkle-leaves")
    sizes = pieces.groupBy("grp").agg(F.sum("n").alias("n"))
    tiers = [_tier(cut_runs(pieces, ["grp"], BLOCK, _ROW.itemsize, "block").join(sizes, "grp"), 0, path)]
    while not tiers[-1].where(F.col("n") > BLOCK).isEmpty():
        tops = tiers[-1].where(F.col("n") > BLOCK).select(
            "grp", F.expr(f"block div {BLOCK}").alias("up"), "n", F.struct("block", F.expr("substring(nodes, -32)").alias("data")).alias("top"))
        # bounded: BLOCK digests a group
        rows = tops.groupBy("grp", "up", "n").agg(F.array_sort(F.collect_list("top")).alias("tops"))
        rows = rows.select("grp", F.col("up").alias("block"), F.expr(f"(n + {BLOCK - 1}) div {BLOCK}").alias("n"),
                           F.aggregate("tops", F.lit(b""), lambda x, y: F.concat(x, y["data"])).alias("data"))
        tiers.append(_tier(rows, len(tiers), path))
    return tiers


def tops(tiers: list[DataFrame]) -> DataFrame:
    """``grp, top`` of every group."""
    one = [t.where(F.col("n") <= BLOCK).select("grp", F.expr("substring(nodes, -32)").alias("top")) for t in tiers]
    out = one[0]
    for t in one[1:]:
        out = out.unionByName(t)
    return out


def nodes(tiers: list[DataFrame]) -> DataFrame:
    """The log itself, a row per entry: ``grp, position, level, index, digest``."""
    def entries(tier, sizes):
        def run(batches):
            for batch in batches:
                for i in range(batch.num_rows):
                    grp, block, n, log, total = (batch.column(j)[i].as_py() for j in range(5))
                    mine = min(BLOCK, n - block * BLOCK)
                    for level, row in enumerate(block_levels(log, mine)):
                        if tier and not level:               # the tops of the tier below
                            continue
                        index = block * ARITY ** (HEIGHT - level) + np.arange(len(row))
                        high = tier * HEIGHT + level
                        yield pa.RecordBatch.from_arrays([pa.array([grp] * len(row), pa.string()), pa.array(position(high, index, total)), pa.array([high] * len(row), pa.int32()),
                                                          pa.array(index), pa.array(row)], names=["grp", "position", "level", "index", "digest"])
        return sizes.mapInArrow(run, "grp string, position long, level int, index long, digest string")

    size = tiers[0].where("block = 0").select("grp", F.col("n").alias("total"))
    out = None
    for k, t in enumerate(tiers):
        rows = entries(k, t.join(size, "grp").select("grp", "block", "n", "nodes", "total"))
        out = rows if out is None else out.unionByName(rows)
    return out


def _steps(held: list[list[str]], i: int) -> bytes:
    """The proof of a block's leaf inside the block."""
    out = []
    for level in held[:-1]:
        run = i - i % ARITY
        mine = level[run:run + ARITY]
        out.append(bytes([i % ARITY, len(mine)]) + bytes.fromhex("".join(mine[:i % ARITY] + mine[i % ARITY + 1:])))
        i //= ARITY
    return b"".join(out)


def _extract(rows: DataFrame, lowest: bool) -> DataFrame:
    """``grp, key, proof, top, root`` of each leaf of the blocks ``grp, block, n,
    ids, nodes, proof, top, root``; ``key`` is the row's id in the lowest tier, and the
    number of the block below in the others."""
    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                grp, block, n, ids, log, proof, top, root = (batch.column(j)[i].as_py() for j in range(8))
                mine = min(BLOCK, n - block * BLOCK)
                held = block_levels(log, mine)
                keys = np.frombuffer(ids, _ROW)["id"].tolist() if lowest else range(block * BLOCK, block * BLOCK + mine)
                yield pa.RecordBatch.from_arrays([
                    pa.array([grp] * mine, pa.string()), pa.array(keys, pa.int64()), pa.array([_steps(held, j) + proof for j in range(mine)], pa.binary()),
                    pa.array([top] * mine, pa.binary()), pa.array([root] * mine, pa.binary())], names=["grp", "key", "proof", "top", "root"])

    return rows.select("grp", "block", "n", "ids", "nodes", "proof", "top", "root").mapInArrow(run, "grp string, key long, proof binary, top binary, root binary")


def _down(tiers: list[DataFrame], above: DataFrame) -> DataFrame:
    """Blocks of the lowest tier with what stands above them: ``proof, top, root``.
    ``above``: these per ``grp``."""
    found = None
    for tier in reversed(range(len(tiers))):
        t = tiers[tier]
        rows = t.where(F.col("n") <= BLOCK).join(above, "grp")
        if found is not None:
            rows = rows.unionByName(t.where(F.col("n") > BLOCK).join(found.withColumnRenamed("key", "block"), ["grp", "block"]))
        if tier == 0:
            return rows
        found = _extract(rows, False)


class Manifest:
    """The logs under ``path``: one per group, and the one over their tops."""

    def __init__(self, spark: SparkSession, leaves: DataFrame, order: list[str], path: str | None = None):
        self.path = path or scratch_path(spark, "merkle-log")
        self.tiers = append_log(leaves, order, f"{self.path}/groups")
        named = tops(self.tiers).withColumn("id", F.monotonically_increasing_id())
        named.write.parquet(f"{self.path}/tops")             # written, so that the ids stay as they are
        self.tops = spark.read.parquet(f"{self.path}/tops")
        over = self.tops.select(F.lit("").alias("grp"), F.col("grp").alias("name"), "id", F.col("top").alias("leaf"), F.lit(None).cast("binary").alias("claim"))
        self.over = append_log(over, ["name"], f"{self.path}/root")

    def root(self) -> DataFrame:
        """One row ``root``, none for an empty table."""
        return tops(self.over).select(F.col("top").alias("root"))

    def placed(self) -> DataFrame:
        """The blocks of leaves with the proof of each block's top."""
        one = tops(self.over).select("grp", F.lit(b"").alias("proof"), "top", F.col("top").alias("root"))
        of_tops = _extract(_down(self.over, one), True).select(F.col("key").alias("id"), "proof", "root")
        return _down(self.tiers, self.tops.join(of_tops, "id").select("grp", "proof", "top", "root"))

    def proofs(self) -> DataFrame:
        """``id, leaf, proof`` of every row (see ``fold``); rows without an id have a NULL one."""
        def run(batches):
            for batch in batches:
                for i in range(batch.num_rows):
                    n, block, ids, log, proof = (batch.column(j)[i].as_py() for j in range(5))
                    held = block_levels(log, min(BLOCK, n - block * BLOCK))
                    rows = np.frombuffer(ids, _ROW)
                    yield pa.RecordBatch.from_arrays([
                        pa.array(rows["id"].copy(), mask=(rows["flags"] & HAS_ID) == 0), pa.array([bytes.fromhex(x) for x in held[0]], pa.binary()),
                        pa.array([_steps(held, j) + proof for j in range(len(rows))], pa.binary())], names=["id", "leaf", "proof"])

        return self.placed().select("n", "block", "ids", "nodes", "proof").mapInArrow(run, "id long, leaf binary, proof binary")

    def audit(self) -> DataFrame:
        """``id, leaf, top, root, siblings_sha256, folded, verified`` (digests in
        hex) of every row. ``siblings_sha256``: of the siblings' hex digests one
        after another; ``folded``: the root that the claimed digest, if there is
        one, else the leaf, leads to with the log's siblings."""
        def run(batches):
            for batch in batches:
                for i in range(batch.num_rows):
                    n, block, ids, log, proof, top, root = (batch.column(j)[i].as_py() for j in range(7))
                    held = block_levels(log, min(BLOCK, n - block * BLOCK))
                    rows = np.frombuffer(ids, _ROW)
                    above, root, top = siblings_text(proof), root.hex(), top.hex()
                    # what stands left and right of each node in its run
                    beside = [[("".join(level[j - j % ARITY:j]), "".join(level[j + 1:j - j % ARITY + ARITY])) for j in range(len(level))] for level in held[:-1]]
                    claims, flags = rows["claim"], rows["flags"].tolist()
                    folds: dict[str, str] = {}
                    sums, folded = [], []
                    for j in range(len(rows)):
                        node = claims[j].tobytes().hex() if flags[j] & HAS_CLAIM else held[0][j]
                        text, k = [], j
                        for level in beside:
                            left, right = level[k]
                            text += (left, right)
                            node, k = hex_digest(left + node + right), k // ARITY
                        if node not in folds:
                            folds[node] = fold(node, proof)
                        sums.append(hex_digest("".join(text) + above))
                        folded.append(folds[node])
                    yield pa.RecordBatch.from_arrays([
                        pa.array(rows["id"].copy(), mask=(rows["flags"] & HAS_ID) == 0), pa.array(held[0]), pa.array([top] * len(rows)), pa.array([root] * len(rows)),
                        pa.array(sums), pa.array(folded), pa.array([f == root for f in folded])],
                        names=["id", "leaf", "top", "root", "siblings_sha256", "folded", "verified"])

        return self.placed().select("n", "block", "ids", "nodes", "proof", "top", "root").mapInArrow(
            run, "id long, leaf string, top string, root string, siblings_sha256 string, folded string, verified boolean")


def group_name(group: Column) -> Column:
    """A group's name as text that sorts like it, NULL first."""
    return F.coalesce(F.concat(F.lit("+"), group.cast("string")), F.lit(""))


def manifest(docs: DataFrame, fields: list[str], group_col: str, id_col: str, claimed: dict[str, Column] | None = None, suspect: Column | None = None,
             path: str | None = None) -> Manifest:
    """The manifest of a table over ``fields``, grouped by ``group_col`` and
    ordered by ``id_col``. Rows for which ``suspect`` holds claim a leaf in which
    the fields in ``claimed`` have other values."""
    leaf = digest(*(F.col(f"`{f}`") for f in fields))
    claim = F.lit(None).cast("binary")
    if suspect is not None:
        claim = F.when(suspect, digest(*((claimed or {}).get(f, F.col(f"`{f}`")) for f in fields)))
    rows = docs.select(group_name(F.col(f"`{group_col}`")).alias("grp"), F.col(f"`{id_col}`").cast("long").alias("id"), leaf.alias("leaf"), claim.alias("claim"))
    path = path or scratch_path(docs.sparkSession, "merkle-log")
    rows.write.parquet(f"{path}/leaves")                     # read twice: range bounds, then rows
    return Manifest(docs.sparkSession, docs.sparkSession.read.parquet(f"{path}/leaves"), ["id"], path)
