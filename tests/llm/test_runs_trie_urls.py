"""Periodic runs, prefix trie and URL filter against brute force on odd rows."""

import hashlib
import math
import random
import zlib
from collections import defaultdict

from rollmill.llm import registry
from rollmill.llm.runs import find_runs, rotated, run_digests
from rollmill.llm.trie import prefix_trie, shared_start_trie
from rollmill.llm.urls import RULES, Rule, aliases, filter_urls

SPACE = " \t\n\x0b\x0c\r"


def slow_runs(words):
    found = []
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            size = j - i + q
            if j > i and size >= max(6, 4 * q):
                own = words[i : i + size]
                if not any(own[p:] == own[:-p] for p in range(1, q)):
                    found.append((i, size, q))
            i = max(j, i + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def slow_words(text):
    for c in SPACE[1:]:
        text = (text or "").replace(c, " ")
    return [w for w in (text or "").split(" ") if w]


def slow_digests(doc_id, words):
    runs = slow_runs(words)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=(None,) * 3)
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    exponent = None if best[0] is None else 1000 * best[1] // best[2]
    return (doc_id, len(runs), *best, exponent, *[hashlib.sha256(x.encode()).hexdigest() for x in (lines, kept)])


def slow_rotated(doc_id, words):
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i if i < a else a + (i - a) % p] for i in range(n)]


def periodic_texts():
    rnd = random.Random(3)
    for _ in range(400):
        words = [rnd.choice("abcé"[: rnd.randint(1, 4)]) for _ in range(rnd.choice((0, 3, 6, 9, 40, 120)))]
        if words and rnd.random() < 0.6:
            a = rnd.randrange(len(words))
            p = rnd.randint(1, max(1, (len(words) - a) // 4))
            words = words[:a] + (words[a : a + p] * len(words))[: len(words) - a]
        yield "".join(w + rnd.choice(SPACE) for w in words)


def test_runs_against_brute_force(spark):
    long = "x y z " * 5000 + "a " + " ".join(f"w{i}" for i in range(3000)) + " q" * 7
    texts = [None, "", " \t\n", "a a a a " * 3, long, *periodic_texts()]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "b " * 9), (None, "b " * 9), (3, "c d " * 8), (-7, "e f g " * 4)]
    docs = spark.createDataFrame([(i, t, 1, 2, "x") for i, t in rows], "doc_id bigint, text string, runs int, row int, collapsed string")
    got = [tuple(r) for r in run_digests(find_runs(docs.repartition(3))).collect()]
    want = [slow_digests(i, slow_words(t)) for i, t in rows if t != long]
    large = [r for r in got if r[0] == 4]
    assert sorted((r for r in got if r[0] != 4), key=str) == sorted(want, key=str)
    assert [r[1:6] for r in large] == [(2, 0, 15000, 3, 5_000_000)]


def test_run_query_rewrites_and_matches_brute_force(spark, root):
    docs = spark.read.parquet(f"{root}/documents.parquet").select("doc_id", "text").collect()
    short = {d.doc_id: slow_rotated(d.doc_id, slow_words(d.text)) for d in docs}
    assert all([w.decode() for w in rotated(i, [x.encode() for x in slow_words(d.text)])] == short[i] for d in docs for i in [d.doc_id])
    got = {r.doc_id: tuple(r) for r in registry.op11_periodic_runs(spark, root).collect()}
    assert len(got) == len(docs)
    for i, words in short.items():
        if len(words) < 600:
            assert got[i] == slow_digests(i, words)
    assert sum(r[1] for r in got.values()) > 5


def test_runs_of_an_empty_table(spark):
    assert run_digests(find_runs(spark.createDataFrame([], "text string, doc_id bigint"))).count() == 0


def slow_trie(rows):
    turns = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            turns[c].append(((t is not None, t or 0), role or "", text or ""))
    plain = {c: [(r, x) for _, r, x in sorted(v)] for c, v in turns.items()}
    whole = {}
    for c, own in plain.items():
        h = zlib.crc32(str(c).encode()) % 6
        whole[c] = tuple(plain.get(c - int(math.fmod(c, 100)), [])[:h]) + tuple(own[h:])
    return slow_nodes(whole)


def slow_nodes(whole):
    members, children = defaultdict(list), defaultdict(set)
    for c, s in whole.items():
        for d in range(len(s) + 1):
            members[s[:d]].append(c)
    for p in members:
        if p:
            children[p[:-1]].add(p)
    leaves, saved = defaultdict(int), defaultdict(int)
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1]) if p else 0
    return [
        (
            min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children[p]), leaves[p], saved[p],
            hashlib.sha256(",".join(map(str, sorted(c for c in m if whole[c] == p))).encode()).hexdigest(),
        )
        for p, m in members.items()
    ]


def test_trie_against_brute_force(spark):
    rnd = random.Random(5)
    rows = []
    for c in [*range(0, 40), *range(100, 130), 250, 301, -5, -101, -100, 9_000_000_000]:
        for t in range(rnd.choice((1, 1, 2, 4, 7))):
            rows.append((c, t, rnd.choice(("user", None)), rnd.choice(("a", "bb", "", None, "ünï\U0001f600"))))
    rows += [(7, None, "system", "first"), (7, None, None, "tie"), (8, 0, "user", "tie"), (8, 0, "user", "tie")]  # NULL and equal turns
    rows += [(20, t, "user", "deep") for t in range(100, 171)] + [(21, t, "user", "deep") for t in range(100, 170)]
    rows += [(None, 0, "user", "no id"), rows[3], rows[3]]
    turns = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id bigint, turn bigint, role string, text string, pos int, node string")
    got = [tuple(r) for r in shared_start_trie(turns.repartition(3)).collect()]
    assert sorted(got, key=str) == sorted(slow_trie(rows), key=str)


def test_trie_of_sequences_with_and_without_turns(spark):
    whole = {1: (), 2: (("", "ab"),), 3: (("", "ab"), ("", "c")), 4: (), 5: (("", "ab"), ("", "c")), 6: (("", "abc"),)}
    rows = [(c, i, t[1], len(t[1]), i == len(s) - 1) for c, s in whole.items() for i, t in enumerate(s)]
    frame = spark.createDataFrame(rows, "conv_id bigint, pos bigint, text string, chars bigint, last boolean").selectExpr(
        "conv_id", "pos", "named_struct('x', xxhash64(text), 'y', xxhash64(text, 1)) as token", "chars", "last"
    )
    convs = spark.createDataFrame([(c, len(s)) for c, s in whole.items()], "conv_id bigint, n bigint")
    assert sorted(map(tuple, prefix_trie(frame, convs).collect()), key=str) == sorted(slow_nodes(whole), key=str)


def test_trie_of_an_empty_table(spark):
    assert shared_start_trie(spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")).count() == 0


PAGES = [
    (1, "https://a.example.org/es/1", None),  # blocked by rule
    (2, "http://plain.example.net/x#top", '<html><head><link rel="canonical" href="https://a.example.org/es/1"></head>'),
    (3, "http://plain.example.net/x", ""),  # the address of 2 without its fragment
    (4, "https://b.example.org/ok", "<LINK HREF=http://plain.example.net/x REL='Nofollow Canonical'>"),  # explicit allow
    (5, "http://far.example.net/y", '<meta http-equiv="Refresh" content="5; URL=\'http://plain.example.net/x\'">'),
    (6, "http://other.example.net/z?q=1", '<!-- <link rel="canonical" href="https://a.example.org/es/1"> --><script>"<link rel=canonical href=https://a.example.org/es/1>"</script>'),
    (7, "http://rel.example.net/a/b", '<base href="http://far.example.net/"><link rel=canonical href="y">'),
    (8, None, "<p>"),
    (9, "mailto:x", None),
    (None, "HTTP://WWW.Example.COM/de/?a", None),
    (None, "HTTP://WWW.Example.COM/de/?a", None),
    (11, "https://example.com/fr/", '<meta http-equiv=refresh content="0;url=/de/2">'),  # its alias is blocked, itself allowed
    (12, "https://x.example.org/en/12", None),
    (13, "https://badexample.org/es/", None),  # not a subdomain of example.org
    (14, "https://example.org", "<link rel=canonical>"),
    (15, "http://hub.example.net/", '<link rel="canonical" href="&#104;ttp://hub.example.net/?a&amp;b">'),
]


def test_url_filter(spark):
    pages = spark.createDataFrame([(*p, 1, "x") for p in PAGES], "page_id bigint, url string, html string, host int, root string")
    got = filter_urls(pages.repartition(3), RULES).collect()
    assert sorted([(r.page_id, r.host, r.path, r.rule, r.verdict) for r in got], key=str) == sorted(
        [
            (1, "a.example.org", "/es/1", "example.org/es/", "block"),
            (2, "plain.example.net", "/x", None, "block"),
            (3, "plain.example.net", "/x", None, "block"),
            (4, "b.example.org", "/ok", "org/", "allow"),
            (5, "far.example.net", "/y", None, "block"),
            (6, "other.example.net", "/z", None, "allow"),
            (7, "rel.example.net", "/a/b", None, "block"),
            (8, "", "", None, "allow"),
            (9, "", "", None, "allow"),
            (None, "www.example.com", "/de/", "com/de/", "block"),
            (None, "www.example.com", "/de/", "com/de/", "block"),
            (11, "example.com", "/fr/", "com/fr/", "allow"),
            (12, "x.example.org", "/en/12", "example.org/en/1", "block"),
            (13, "badexample.org", "/es/", "org/", "allow"),
            (14, "example.org", "", None, "allow"),
            (15, "hub.example.net", "/", None, "allow"),
        ],
        key=str,
    )
    assert {r.page_id for r in got if r.blocked} == {2, 3, 4, 5, 7, 11, 1}
    assert filter_urls(pages.limit(0), RULES).count() == 0


def test_blocks_spread_along_chains_and_hubs(spark):
    """A blocked end reaches all of a chain of 200 pages and of a hub's 300 aliases; other components stay as they are."""
    page = '<link rel="canonical" href="http://{}">'
    chain = [(i, f"http://c.example.net/{i}", page.format(f"c.example.net/{i + 1}")) for i in range(200)]
    hub = [(1000 + i, f"http://h.example.net/{i}", page.format("h.example.net/hub")) for i in range(300)]
    free = [(2000 + i, f"http://f.example.net/{i}", page.format("f.example.net/hub")) for i in range(20)]
    rules = [Rule("block", "c.example.net", "/200"), Rule("block", "h.example.net", "/7"), Rule("allow", "h.example.net", "/70")]
    pages = spark.createDataFrame(chain + hub + free, "page_id bigint, url string, html string")
    got = {r.page_id: r.verdict for r in filter_urls(pages, rules).collect()}
    assert {i for i, v in got.items() if v == "allow"} == {1070} | {2000 + i for i in range(20)}


def test_aliases_are_absolute():
    assert aliases("http://a.net/x/y?z", '<link rel="canonical" href="../q#f">') == ["http://a.net/q"]
    assert aliases(None, '<link rel="canonical" href="/q">') == []
    assert aliases("http://a.net/", '<meta http-equiv="refresh" content="30"><link rel="canonical" href="http://[bad">') == []
