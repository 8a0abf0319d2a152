"""The second search sends vectors per cell of pages and block of queries, not per page and query (F1 of round 4)."""

import numpy as np

from rollmill.llm import mtree as T


def test_queries_and_pages_meet_in_cells(spark, monkeypatch):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(1000, 6)) / 3
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>")
    monkeypatch.setattr(T, "PAGE_ROWS", 8)
    monkeypatch.setattr(T, "CELL_BYTES", 8 * 6 * 32, raising=False)  # 32 queries, or 4 pages, a task
    sent, visit = [], T.visit

    def seen(pages, asked, *rest):
        sent.append((pages.count(), asked.count(), asked.schema["q"].dataType.simpleString()))
        return visit(pages, asked, *rest)

    monkeypatch.setattr(T, "visit", seen)
    got = sorted(map(tuple, T.top_k(df, k=5).select("query_id", "rank", "vec_id", "score").collect()))
    whole = np.floor(64 * x).astype(int)
    want = []
    for q in range(0, 1000, 20):
        scores = sorted((-int(s), i) for i, s in enumerate(whole @ whole[q]) if i != q)
        want += [(q, rank, i, -s) for rank, (s, i) in enumerate(scores[:5], 1)]
    assert got == sorted(want)
    (_, first, _), (copies, rows, kind) = sent
    n_pages = copies // 2  # two blocks of queries
    assert first == 50 and n_pages >= 125
    assert rows <= 50 * -(-n_pages // 4) and kind == "binary"
    assert T.unpacked([], 6).shape == (0, 6) and T.unpacked([b"", b""], 0).shape == (2, 0)


def test_packed_vectors_come_back():
    for top in (5, 300, 70_000, 2.0**40):
        x = np.array([[0, -3, top], [1, 2, -top]], float)
        assert (T.unpacked([v.tobytes() for v in T.packed(x)], 3) == x).all()
