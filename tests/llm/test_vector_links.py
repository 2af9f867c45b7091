import numpy as np
import pytest

from txrisk.llm import vector_links as vl


def _brute(rows, threshold=0.9):
    ok = [v is not None and len(v) > 0 and None not in v and np.isfinite(v).all() and np.any(v) for _, v in rows]
    parent, links = list(range(len(rows))), [0] * len(rows)

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i, (_, a) in enumerate(rows):
        for j in range(i):
            b = rows[j][1]
            if ok[i] and ok[j] and len(a) == len(b):
                x, y = np.array(a, float), np.array(b, float)
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= threshold:
                    links[i] += 1
                    links[j] += 1
                    parent[find(i)] = find(j)
    out = []
    for i, (d, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        c = min(ids, default=None)
        out.append((d, links[i], c, d == c))
    return sorted(out, key=repr)


def _rows(df):
    return sorted([(r.vec_id, r.n_links, r.component_id, r.kept) for r in df.collect()], key=repr)


SCHEMA = "vec_id long, embedding array<float>, label int, node string"


def test_edges(spark):
    v = [1.0, 2.0, 3.0]
    rows = [(9, v), (4, v), (4, v), (None, v), (5, None), (6, []), (7, [0.0] * 3), (8, [1.0, None, 2.0]),
            (10, [float("nan"), 1.0, 1.0]), (11, [2.0, 4.0, 6.0]), (12, [1.0, 2.0]), (13, [-1.0, -2.0, -3.0]),
            (14, [float("inf"), 1.0, 1.0]), (None, [5.0, -1.0, 0.0])]
    df = spark.createDataFrame([(i, x, 1, "c") for i, x in rows], SCHEMA)
    assert _rows(vl.vector_links(df)) == _brute(rows)
    assert vl.vector_links(df.limit(0)).count() == 0


@pytest.mark.parametrize("sizes", [[60, 30, 5, 2, 2], [150]])
def test_groups_of_near_copies(spark, sizes, monkeypatch):
    """Lists with room for 8 links must grow for groups that are larger."""
    monkeypatch.setattr(vl, "LINKS", 8)
    monkeypatch.setattr(vl, "_GROWTH", 4)
    rng = np.random.default_rng(4)
    rows = []
    for n in sizes:
        centre = rng.normal(size=32)
        rows += [centre + rng.normal(size=32) * 0.12 for _ in range(n)]
    rows += list(rng.normal(size=(100, 32)))
    order = rng.permutation(len(rows))
    rows = [(int(i), np.float32(rows[k]).tolist()) for i, k in enumerate(order)]
    df = spark.createDataFrame([(i, x, 0, "c") for i, x in rows], SCHEMA)
    want, got = _brute(rows), _rows(vl.vector_links(df))
    assert [w[2] for w in want] == [g[2] for g in got]
    assert sum(g[1] for g in got) >= 0.98 * sum(w[1] for w in want)
    assert all(g[1] <= w[1] for g, w in zip(got, want))


def test_query(spark):
    from txrisk.llm.queries import QUERIES
    sf = "/root/testdata/sf0.01"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    assert _rows(QUERIES["op9_vector_links"](spark, sf)) == _brute(rows)


def _search(spark, rows):
    nodes = spark.createDataFrame([(i, len(x), bytearray(np.float32(x).tobytes())) for i, x in enumerate(rows)],
                                  "node long, dim int, vec binary")
    return vl._Search(nodes, "<f4", 0.9)


@pytest.mark.parametrize("hot", [0, 200])
def test_audit_sees_lost_pairs(spark, hot, monkeypatch):
    """Three pairs among 1,500 vectors are lost, whether or not a large group is held."""
    monkeypatch.setattr(vl, "AUDIT", 64)
    rng = np.random.default_rng(6)
    group = rng.normal(size=64) + rng.normal(size=(hot, 64)) * 0.1
    lone = rng.normal(size=(1500, 64))
    search = _search(spark, [*group, *lone, *(lone[:3] + rng.normal(size=(3, 64)) * 0.1)])
    together = spark.range(hot + 1500).selectExpr(f"if(id < {hot}, -1L, id) as bucket", "id as node")
    graph = search.refined(None, together)
    assert search.links(graph).count() == hot * (hot - 1) // 2
    assert search.recall(graph) < vl.RECALL
    whole = search.refined(graph, spark.range(hot + 1503).selectExpr("0L as bucket", "id as node"))
    assert search.recall(whole) == 1.0


def test_below_target_ends_in_all_pairs(spark, monkeypatch):
    """Seedings that never bring two vectors together must not end in lost links."""
    monkeypatch.setattr(vl._Search, "seeded", lambda self, *_: self.nodes.selectExpr("node as bucket", "node"))
    monkeypatch.setattr(vl, "_SLICE", 100)
    rng = np.random.default_rng(8)
    rows = rng.normal(size=(150, 32))
    rows = [*rows, *(rows[:100] + rng.normal(size=(100, 32)) * 0.1), *(rows[:40] * 2)]
    rows = [(i, np.float32(x).tolist()) for i, x in enumerate(rows)]
    df = spark.createDataFrame([(i, x, 0, "c") for i, x in rows], SCHEMA)
    assert _rows(vl.vector_links(df)) == _brute(rows)


def test_rare_pairs_are_audited_by_witnesses(spark, monkeypatch):
    """Pairs too rare for the random slices: the audit's passes stay bounded,
    its vectors come from cells of their own, and no pair is lost."""
    monkeypatch.setattr(vl, "_SLICE", 64)
    monkeypatch.setattr(vl, "CELL", 32)
    rng = np.random.default_rng(12)
    x = rng.normal(size=(4000, 24))
    for i in range(60):
        x[2 * i + 1] = x[2 * i] + 0.2 * rng.normal(size=24)
    audits, made = [], vl._Search.sets_of
    monkeypatch.setattr(vl._Search, "sets_of", lambda self, some: audits.append(1) or made(self, some))
    df = spark.createDataFrame([(i, [float(a) for a in v]) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {r.vec_id: r for r in vl.vector_links(df).collect()}
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    linked = (unit @ unit.T >= 0.9).sum(axis=1) - 1
    found = np.array([got[i].n_links for i in range(len(x))])
    assert (found <= linked).all() and found.sum() >= 0.95 * linked.sum() > 80
    assert len(audits) <= vl.AUDIT_SLICES + len(vl.WITNESS_SEEDS)
