"""The Merkle log against a brute-force tree."""

import hashlib
import random
import zlib

import numpy as np
import pytest
import pyspark.sql.types as T

from conftest import SF_SMALL
from tidemark.llm import merkle_log as ML
from tidemark.llm import queries as Q

DOC = "doc_id long, source string, lang string, n_chars long, text string, grp string, block long"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree(level):
    """The levels over a list of digests."""
    out = [level]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i:i + 8]) for i in range(0, len(out[-1]), 8)])
    return out


def siblings(levels, i):
    out = []
    for level in levels[:-1]:
        run = level[i - i % 8:i - i % 8 + 8]
        out.append((i % 8, run[:i % 8] + run[i % 8 + 1:]))
        i //= 8
    return out


def brute(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in names:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[g] = tree([leaf(r) for r in groups[g]])
    over = tree([trees[g][-1][0] for g in names])
    out = []
    for k, g in enumerate(names):
        for i, r in enumerate(groups[g]):
            path = siblings(trees[g], i) + siblings(over, k)
            node = leaf(r)
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and r[4] is not None:
                node = leaf(r[:4] + ("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r[4]),))
            for place, others in path:
                node = h(*others[:place], node, *others[place:])
            out.append((r[0], leaf(r), trees[g][-1][0], over[-1][0], h(*(x for _, o in path for x in o)), node, node == over[-1][0]))
    return sorted(out, key=str)


def ours(df):
    return sorted(((r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified) for r in df.collect()), key=str)


def fill(spark, path, rows):
    spark.createDataFrame([r + ("g", 3) for r in rows], DOC).repartition(3).write.parquet(f"{path}/documents.parquet")


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "source", "lang", "n_chars", "text").collect()]
    assert ours(Q.op12_merkle_manifest(spark, SF_SMALL)) == brute(rows)


def test_query_on_odd_rows_and_several_tiers(spark, tmp_path, monkeypatch):
    rng = random.Random(4)
    rows = [(rng.choice([None, rng.randrange(900), rng.randrange(900)]), rng.choice([None, "web", ""]), rng.choice(["en"] * 8 + [None, "", "de", "é", "zz"]), rng.choice([None, 4]),
             rng.choice([None, "", "Abc", "ÉCOLE é", "low", "LONG " * 9000])) for _ in range(700)]
    rows += rows[:40] + [(5, "s", "only", 1, "One")]
    for height in (1, 2):                                # smaller blocks, so that a few hundred leaves fill several tiers
        monkeypatch.setattr(ML, "HEIGHT", height)
        monkeypatch.setattr(ML, "BLOCK", 8 ** height)
        path = str(tmp_path / str(height))
        fill(spark, path, rows)
        # workers import the module anew, so this runs the builders in this process
        assert ours_local(spark, path) == brute(rows)


def ours_local(spark, path):
    """The query with its tasks run in this process."""
    from pyspark.sql import DataFrame

    def local(self, f, schema):
        import pyarrow as pa
        got = [b for b in f(iter(self.coalesce(1).toArrow().to_batches()))]
        return spark.createDataFrame(pa.Table.from_batches(got), schema) if got else spark.createDataFrame([], schema)

    with pytest.MonkeyPatch.context() as m:
        from tidemark.llm import runs
        m.setattr(runs.TaskContext, "get", staticmethod(lambda: type("C", (), {"partitionId": lambda s: 0})()))
        m.setattr(DataFrame, "mapInArrow", local)
        m.setattr(type(spark.range(1)), "mapInArrow", local)
        return ours(Q.op12_merkle_manifest(spark, path))


def test_empty_table_and_single_rows(spark, tmp_path):
    fill(spark, str(tmp_path / "none"), [])
    assert Q.op12_merkle_manifest(spark, str(tmp_path / "none")).count() == 0
    rows = [(1, None, "x", 2, "T"), (7, None, "y", 2, "T")]
    fill(spark, str(tmp_path / "two"), rows)
    assert ours(Q.op12_merkle_manifest(spark, str(tmp_path / "two"))) == brute(rows)
    fill(spark, str(tmp_path / "one"), rows[:1])
    assert ours(Q.op12_merkle_manifest(spark, str(tmp_path / "one"))) == brute(rows[:1])


@pytest.mark.parametrize("n", [1, 2, 8, 9, 64, 65, 100, 513, 600])
def test_positions_are_the_completion_order(n):
    leaves = [h(str(i)) for i in range(n)]
    log, whole = ML.append_block(leaves, ML.levels(n)), tree(leaves)
    assert len(log) == sum(map(len, whole)) and log[-1] == whole[-1][0]
    for level, row in enumerate(whole):
        assert [log[p] for p in ML.position(level, np.arange(len(row)), n).tolist()] == row
    assert ML.block_levels(bytes.fromhex("".join(log)), n) == whole


def test_proofs_lead_to_the_root_and_the_log_has_every_position(spark):
    rows = [(i, "s", "en" if i % 9 else "de", 3, f"Text {i}") for i in range(5000)]
    found = ML.manifest(spark.createDataFrame([r + ("g", 3) for r in rows], DOC), ["doc_id", "text"], "lang", "doc_id")
    root = found.root().first()["root"].hex()
    proofs = found.proofs().collect()
    assert len(proofs) == 5000 and all(ML.fold(bytes(r.leaf).hex(), bytes(r.proof)) == root for r in proofs)
    assert ML.fold(h("other"), bytes(proofs[0].proof)) != root
    for g in ("+en", "+de"):
        log = ML.nodes(found.tiers).where(f"grp = '{g}'").orderBy("position").collect()
        assert [r.position for r in log] == list(range(len(log)))
        done = {}
        for r in log:                                    # a parent comes right after its last child
            if r.level:
                assert r.digest == h(*done[r.level - 1][r["index"] * 8:r["index"] * 8 + 8])
            done.setdefault(r.level, []).append(r.digest)
