"""Exact top-k by inner product: best-first search over an M-tree of paged metric nodes."""

from __future__ import annotations

import pickle

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollmill.llm.common import written
from rollmill.plans.scale import attach

PAGE_ROWS = 4096
LEAF_ROWS = 64
FANOUT = 16
QUERY_ROWS = 512
#: Rows that meet all routing objects at once.
ROUTE_ROWS = 1024
#: Vectors of pages, and those of queries, that a task of the second search holds, as doubles: neither grows with the tables.
CELL_BYTES = 1 << 25
#: Routing objects of the root: one for every page, within these bounds.
ROOTS = (8, 1024)
EXACT = 2.0**52  # sums of products below this are exact in doubles

VECTOR = "transform(embedding, x -> cast(floor(64 * cast(x as double)) as double))"
BROKEN = "exists(embedding, x -> x is null or isnan(x) or abs(x) = double('infinity'))"


def quantised(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """vec_id, e (array of whole doubles). Rows without id, vector or a finite number in every component take no part."""
    rows = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).alias("embedding"))
    whole = rows.where("vec_id is not null and embedding is not null").where(f"not {BROKEN}")
    return whole.select("vec_id", F.expr(VECTOR).alias("e"))


def stacked(values, width: int) -> np.ndarray:
    """Rows of equal width; shorter vectors end in zeros."""
    out = np.zeros((len(values), width))
    for i, v in enumerate(values):
        out[i, : len(v)] = v
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products of rows; beyond the exact range of doubles they are summed as integers."""
    if a.size and b.size and np.sqrt((a * a).sum(axis=1).max() * (b * b).sum(axis=1).max()) >= EXACT:
        return (a.astype(np.int64)[:, None, :] * b.astype(np.int64)[None, :, :]).sum(axis=2)
    return a @ b.T


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    squares = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2 * (a @ b.T)
    return np.sqrt(np.maximum(squares, 0))


def spread_out(x: np.ndarray, n: int) -> np.ndarray:
    """Indices of `n` routing objects, each as far from the earlier ones as possible."""
    chosen, far = [0], distances(x, x[:1])[:, 0]
    while len(chosen) < min(n, len(x)) and far.max() > 0:
        chosen.append(int(far.argmax()))
        far = np.minimum(far, distances(x, x[chosen[-1:]])[:, 0])
    return np.array(chosen)


def build_page(ids: np.ndarray, x: np.ndarray) -> dict:
    """An M-tree over one page: inner nodes over leaf nodes over vectors.

    Every node stores its routing object, its covering radius and the distance to its parent's
    routing object; every vector the distance to its leaf's.
    """
    inner = x[spread_out(x, FANOUT)]
    nearest = distances(x, inner).argmin(axis=1)
    order, starts, centers, parents = [], [0], [], []
    for node in range(len(inner)):
        members = np.flatnonzero(nearest == node)
        if not len(members):
            continue
        routing = x[members][spread_out(x[members], -(-len(members) // LEAF_ROWS))]
        leaf = distances(x[members], routing).argmin(axis=1)
        for k in range(len(routing)):
            mine = members[leaf == k]
            if len(mine):
                order.append(mine)
                starts.append(starts[-1] + len(mine))
                centers.append(routing[k])
                parents.append(node)
    order, centers, parents = np.concatenate(order), np.array(centers), np.array(parents)
    x, ids, starts = x[order], ids[order], np.array(starts)
    leaf_of = np.repeat(np.arange(len(centers)), np.diff(starts))
    to_leaf = np.linalg.norm(x - centers[leaf_of], axis=1)
    to_inner = np.linalg.norm(x - inner[parents[leaf_of]], axis=1)
    return {
        "ids": ids,
        "x": x,
        "starts": starts,
        "centers": centers,
        "parents": parents,
        "radius": np.maximum.reduceat(to_leaf, starts[:-1]),
        "parent_distance": np.linalg.norm(centers - inner[parents], axis=1),
        "to_leaf": to_leaf,
        "inner": inner,
        "inner_radius": np.array([to_inner[parents[leaf_of] == i].max(initial=0) for i in range(len(inner))]),
    }


def best_case(norm_q: np.ndarray, norm_o: np.ndarray, distance: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """No vector within `radius` of o has a larger inner product with q, if d(q, o) is at least `distance`.

    A little is added for rounding: a node is only left out if it is worse for certain.
    """
    center = (norm_q[:, None] ** 2 + norm_o[None, :] ** 2 - distance**2) / 2
    reach = norm_q[:, None] * radius[None, :]
    return center + reach + 1e-9 * (norm_q[:, None] ** 2 + norm_o[None, :] ** 2 + reach) + 1e-6


def leading(found: list[tuple], k: int) -> tuple[tuple, np.ndarray]:
    """The k best of each query among `found` (query, vec_id, score), ties to smaller ids, and where the k-th ones are."""
    query, ids, scores = (np.concatenate(x) for x in zip(*found, strict=True))
    ranked = np.lexsort((ids, -scores, query))
    query, ids, scores = query[ranked], ids[ranked], scores[ranked]
    rank = np.arange(len(query)) - np.searchsorted(query, query)
    ahead = rank < k
    return (query[ahead], ids[ahead], scores[ahead]), np.flatnonzero(rank[ahead] == k - 1)


def search_page(page: dict, q: np.ndarray, least: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query index, vec_id, score): each query's k best in the page, ties to smaller ids.

    least: scores below it are of no interest. Each query opens leaves best case first, in widening steps, and
    stops when the next one cannot reach its k-th score. Distances to leaves, and products with vectors, are
    computed only where the stored distance to the parent leaves room (triangle inequality).
    """
    norm_q, norm_c = np.linalg.norm(q, axis=1), np.linalg.norm(page["centers"], axis=1)
    to_inner = distances(q, page["inner"])
    bound = best_case(norm_q, np.linalg.norm(page["inner"], axis=1), to_inner, page["inner_radius"])[:, page["parents"]]
    apart = np.abs(to_inner[:, page["parents"]] - page["parent_distance"])
    bound = np.minimum(bound, best_case(norm_q, norm_c, apart, page["radius"]))
    needed = np.flatnonzero((bound >= least[:, None]).any(axis=0))
    to_leaf = apart
    if len(needed):
        to_leaf[:, needed] = distances(q, page["centers"][needed])
        exact = best_case(norm_q, norm_c[needed], to_leaf[:, needed], page["radius"][needed])
        bound[:, needed] = np.minimum(bound[:, needed], exact)
    order = np.argsort(-bound, axis=1, kind="stable")
    norm_x = np.linalg.norm(page["x"], axis=1)
    best = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)  # query, vec_id, score
    floor, first, wide = least.astype(float), 0, 1
    while first < order.shape[1]:  # the next best leaf, then the next two, four, ...
        leaves = order[:, first : first + wide]
        alive = np.take_along_axis(bound, leaves, axis=1) >= floor[:, None]
        if not alive.any():
            break
        query, leaf = np.nonzero(alive)[0], leaves[alive]
        by_leaf = np.argsort(leaf, kind="stable")
        query, leaf = query[by_leaf], leaf[by_leaf]
        edges = np.flatnonzero(np.concatenate([[True], leaf[1:] != leaf[:-1], [True]]))
        found = [best]
        for lo, hi in zip(edges[:-1], edges[1:], strict=True):
            node, mine = leaf[lo], query[lo:hi]
            rows = np.arange(page["starts"][node], page["starts"][node + 1])
            gap = np.abs(to_leaf[mine, node][:, None] - page["to_leaf"][rows])
            possible = best_case(norm_q[mine], norm_x[rows], gap, np.zeros(len(rows))) >= floor[mine][:, None]
            rows = rows[possible.any(axis=0)]
            scores = products(q[mine], page["x"][rows])
            i, j = np.nonzero(scores >= floor[mine][:, None])
            found.append((mine[i], page["ids"][rows[j]], scores[i, j]))
        best, last = leading(found, k)
        floor[best[0][last]] = np.maximum(floor[best[0][last]], best[2][last])
        first, wide = first + wide, 2 * wide
    return best[0], best[1], best[2].astype(np.int64)


def search_pages(pages: list[dict], q: np.ndarray, least: np.ndarray, bound: np.ndarray, k: int) -> tuple:
    """As search_page, over several pages: every page raises the score that the next ones must reach.

    bound: no score of the query in the page is higher (a row per query, a column per page); NaN: it is not searched.
    """
    floor, best = least.astype(float), (np.empty(0, np.int64),) * 3
    for n, page in enumerate(pages):
        mine = np.flatnonzero(bound[:, n] >= floor)
        if len(mine):
            i, ids, scores = search_page(page | {"x": page["x"].astype(np.float64)}, q[mine], floor[mine], k)
            best, last = leading([best, (mine[i], ids, scores)], k)
            floor[best[0][last]] = np.maximum(floor[best[0][last]], best[2][last])
    return best


def packed(x: np.ndarray) -> np.ndarray:
    """Whole numbers in the smallest type that holds them."""
    low, high = x.min(initial=0), x.max(initial=0)
    for kind in (np.int8, np.int16, np.int32):
        if np.iinfo(kind).min <= low and high <= np.iinfo(kind).max:
            return x.astype(kind)
    return x


def unpacked(rows, width: int) -> np.ndarray:
    """Vectors from the bytes of `packed` ones."""
    out = np.zeros((len(rows), width))
    for i, v in enumerate(rows if width else []):
        out[i] = np.frombuffer(v, {1: np.int8, 2: np.int16, 4: np.int32, 8: np.float64}[len(v) // width])
    return out


def few(batches, rows: int = ROUTE_ROWS):
    """The same rows in smaller frames."""
    for pdf in batches:
        for at in range(0, len(pdf), rows):
            yield pdf.iloc[at : at + rows]


def page_rows(width: int):
    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("vec_id", kind="stable")
        page = build_page(pdf["vec_id"].to_numpy(), stacked(pdf["e"].tolist(), width))
        page["x"] = packed(page["x"])
        return pd.DataFrame({"page": [pdf["page"].iloc[0]], "nodes": [pickle.dumps(page)]})

    return build


def visit(pages: DataFrame, asked: DataFrame, bounds, width: int, k: int) -> DataFrame:
    """qid, vec_id, score: for every (cell, query) in `asked` (cell, block, qid, q, own, least) the k best in the pages of the cell.

    pages: (cell, block, page, nodes). A cell's queries come in blocks, each with its own copy of the pages; a task
    goes through QUERY_ROWS of them at a time. bounds(queries, their own pages, pages): the bounds of search_pages.
    """

    def run(some: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        found = [pd.DataFrame({"qid": [], "vec_id": [], "score": []}, dtype="int64")]
        some, queries = some.sort_values("page"), queries.sort_values("qid")
        opened = [pickle.loads(n) for n in some["nodes"]] if len(queries) else []
        for part in few([queries] if opened else [], QUERY_ROWS):
            q, qid = unpacked(part["q"].tolist(), width), part["qid"].to_numpy()
            bound = bounds(q, part["own"].to_numpy(), some["page"].to_numpy())
            i, ids, scores = search_pages(opened, q, part["least"].to_numpy(float), bound, k)
            found.append(pd.DataFrame({"qid": qid[i], "vec_id": ids, "score": scores}))
        return pd.concat(found)

    met = pages.groupBy("cell", "block").cogroup(asked.groupBy("cell", "block"))
    return met.applyInPandas(run, "qid bigint, vec_id bigint, score bigint")


def best(found: DataFrame, by: list[str], k: int) -> DataFrame:
    order = f"row_number() over (partition by {', '.join(by)} order by score desc, vec_id)"
    return found.withColumn("rank", F.expr(order)).where(F.col("rank") <= k)


def top_k(
    vectors: DataFrame, k: int = 20, every: int = 20, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """Columns query_id, rank (from 1), vec_id, score: the k highest integer inner products of each query.

    Components become floor(64 * x). Queries are the rows whose id is divisible by `every`, candidates all rows with another
    id; ties go to the smaller id; fewer than k candidates give all. Vectors that are NULL or hold NULL, NaN or
    infinity, and rows without id, take no part. Shorter vectors count as if they ended in zeros. Rows repeated
    in full count once. Other columns are not read; empty tables, or tables without queries, give no rows.

    1. Copies: of equal vectors only the smallest ids can be among a query's best, and equal queries are searched once.
    2. The root: routing objects from a bounded sample; every vector goes to the nearest, then to a page of
       about PAGE_ROWS vectors. A page is one task's M-tree (build_page).
    3. Each query searches one page under its own routing object. Its k-th score there prunes the root's
       other subtrees by their covering radii; it then searches all pages of those that are left. A task takes some
       neighbouring pages and a block of queries, within CELL_BYTES each: vectors are not sent once per page and query.
    """
    rows = written(quantised(vectors, id_col, vector_col).distinct().withColumn("h", F.xxhash64("e")), "vectors")
    same_id = rows.groupBy("vec_id").count().agg(F.max("count").alias("n")).first().n or 1
    k_all = k + int(same_id)  # a query's own rows are left out at the end
    width = rows.agg(F.max(F.size("e")).alias("n")).first().n or 0
    first = F.expr("row_number() over (partition by h, e order by vec_id)")
    kept = written(rows.withColumn("r", first).where(F.col("r") <= k_all).select("vec_id", "e"), "kept")
    queries = rows.where(F.pmod("vec_id", F.lit(every)) == 0)
    searched = written(queries.groupBy("h", "e").agg(F.min("vec_id").alias("qid")), "queries")

    wanted = min(max(-(-kept.count() // PAGE_ROWS), ROOTS[0]), ROOTS[1])
    drawn = kept.orderBy(F.xxhash64("vec_id"), "vec_id", "e").limit(8 * wanted).select("e").collect()
    if not drawn:
        return kept.selectExpr("vec_id as query_id", "0 as rank", "vec_id", "0L as score")
    sample = stacked([r.e for r in drawn], width)
    roots = sample[spread_out(sample, wanted)]

    def route(batches):
        for pdf in few(batches):
            apart = distances(stacked(pdf["e"].tolist(), width), roots)
            nearest = apart.argmin(axis=1)
            yield pdf.assign(root=nearest.astype("int32"), d=apart[np.arange(len(pdf)), nearest])

    routed = written(kept.mapInPandas(route, "vec_id bigint, e array<double>, root int, d double"), "routed")
    facts = routed.groupBy("root").agg(F.count(F.lit(1)).alias("n"), F.max("d").alias("d")).collect()  # ROOTS[1] at most
    radius, pages_of, at = np.full(len(roots), -np.inf), {}, 0
    for r in sorted(facts):
        n = -(-r.n // PAGE_ROWS)
        radius[r.root], pages_of[r.root], at = r.d, range(at, at + n), at + n
    spread = " ".join(f"when {r} then {p.start} + pmod(xxhash64(vec_id, 3), {len(p)})" for r, p in pages_of.items())
    paged = routed.select("vec_id", "e", F.expr(f"cast(case root {spread} end as int)").alias("page"))
    pages = written(paged.groupBy("page").applyInPandas(page_rows(width), "page int, nodes binary"), "pages")

    def home(batches):
        """Rows (qid, q, own): the first page of the nearest root with vectors."""
        for pdf in few(batches):
            q = stacked(pdf["e"].tolist(), width)
            apart = distances(q, roots)
            apart[:, ~np.isfinite(radius)] = np.inf
            own = [pages_of[r][0] for r in apart.argmin(axis=1).tolist()]
            yield pd.DataFrame({"qid": pdf["qid"], "q": [v.tobytes() for v in packed(q)], "own": own})

    def reach(q: np.ndarray) -> np.ndarray:
        """No vector under a root (column) has a larger product with a query (row)."""
        bound = best_case(np.linalg.norm(q, axis=1), np.linalg.norm(roots, axis=1), distances(q, roots), np.maximum(radius, 0))
        bound[:, ~np.isfinite(radius)] = np.nan
        return bound

    task_queries, task_pages = (max(1, CELL_BYTES // (8 * max(1, width) * n)) for n in (1, PAGE_ROWS))
    homes = written(searched.mapInPandas(home, "qid bigint, q binary, own int"), "homes")
    asking = {r.own: r.n for r in homes.groupBy("own").agg(F.count(F.lit(1)).alias("n")).collect()}  # ROOTS[1] at most
    crowded = "".join(f" when {p} then {-(-n // task_queries)}" for p, n in asking.items() if n > task_queries)
    copies = f"case cell{crowded} else 1 end" if crowded else "1"
    block = "cast(pmod(xxhash64(qid), {}) as int) as block"
    unknown = homes.selectExpr("own as cell", "*", "double('-inf') as least").selectExpr("*", block.format(copies))
    first_pages = pages.where(F.col("page").isin(list(asking))).selectExpr("page as cell", "*")
    first_pages = first_pages.selectExpr("*", f"explode(sequence(0, {copies} - 1)) as block")
    near = written(visit(first_pages, unknown, lambda q, own, page: np.full((len(q), len(page)), np.inf), width, k_all), "near")

    blocks = -(-sum(asking.values()) // task_queries)
    size = min(task_pages, max(1, at * blocks // (4 * kept.sparkSession.sparkContext.defaultParallelism)))  # pages of a cell
    root_of = np.empty(at, np.int64)
    under = np.zeros((len(roots), -(-at // size)), np.float32)
    for r, p in pages_of.items():
        root_of[p.start : p.stop] = r
        under[r, p.start // size : (p.stop - 1) // size + 1] = 1

    def ask(batches):
        """All columns and `cells`: those with a page in reach, other than the query's own."""
        for pdf in few(batches):
            asked = (reach(unpacked(pdf["q"].tolist(), width)) >= pdf["least"].to_numpy()[:, None]).astype(np.float32) @ under > 0
            if size == 1:
                asked[np.arange(len(pdf)), pdf["own"]] = False
            yield pdf.assign(cells=[np.flatnonzero(a).astype(np.int32) for a in asked])

    def in_reach(q: np.ndarray, own: np.ndarray, page: np.ndarray) -> np.ndarray:
        return np.where(own[:, None] == page, np.nan, reach(q)[:, root_of[page]])

    floor = best(near, ["qid"], k_all).where(F.col("rank") == k_all).select(F.col("qid").alias("_q"), "score")
    known = homes.join(floor, homes.qid == floor._q, "left").select(
        "qid", "q", "own", F.coalesce(F.col("score").cast("double"), F.lit(float("-inf"))).alias("least")
    )
    told = known.mapInPandas(ask, "qid bigint, q binary, own int, least double, cells array<int>")
    asked = told.select(F.explode("cells").alias("cell"), "qid", "q", "own", "least").selectExpr("*", block.format(blocks))
    in_cells = pages.selectExpr(f"cast(page div {size} as int) as cell", "*", f"explode(sequence(0, {blocks - 1})) as block")
    rest = visit(in_cells, asked, in_reach, width, k_all)
    found = best(near.union(rest), ["qid"], k_all).select("qid", "vec_id", "score")
    owners = attach(queries, searched, ["h", "e"], "inner").select(F.col("vec_id").alias("query_id"), "qid")
    met = attach(owners, found.groupBy("qid").agg(F.collect_list(F.struct("vec_id", "score")).alias("found")), ["qid"], "inner")
    each = met.select("query_id", "qid", F.explode("found").alias("x")).select("query_id", "qid", "x.vec_id", "x.score")
    ranked = best(each.where("vec_id != query_id"), ["query_id", "qid"], k)
    return ranked.select("query_id", "rank", "vec_id", "score")
