import numpy as np
import pytest
from compare import differences, sql_engine

from rankweave.llm import lines, urls, vectors
from rankweave.llm.queries import ORACLE_SQL, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, small_dir, name):
    assert differences(spark, sql_engine(small_dir), QUERIES[name], ORACLE_SQL[name], small_dir) == []


def _cut(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' as key", "1 as runs", "'h' as lines")
    return sorted(((r.doc_id, r.text, r.deleted_lines) for r in lines.dedup_lines(docs).collect()), key=str)


def _line(seed, n):
    return " ".join(f"w{seed}x{i}" for i in range(n))


def test_later_copies_of_long_runs_go(spark):
    a, b, c, short = _line(1, 30), _line(2, 30), _line(3, 60), _line(4, 10)
    rows = [
        (1, f"{a}\n{b}\nend"),
        (2, f"own\n{a}\n\n{b}\ntail"),  # a blank line inside the run goes with it
        (3, f"{a}\nelse"),  # thirty words repeat: too short a run
        (4, c),
        (5, f"{c}\n{c}"),
        (6, f"{short}\nx"),
        (7, f"{short}\ny"),
        (8, None),
        (9, ""),
        (None, c),
        (4, c),
    ]
    got = _cut(spark, rows)
    want = [(1, f"{a}\n{b}\nend", 0), (2, "own\ntail", 3), (3, f"{a}\nelse", 0), (4, c, 0), (4, c, 0), (5, "", 2), (6, f"{short}\nx", 0), (7, f"{short}\ny", 0), (8, None, 0), (9, "", 0), (None, "", 1)]
    assert got == sorted(want, key=str)


def test_a_line_in_most_documents_is_one_pair_each(spark):
    hot = _line(9, 55)
    rows = [(i, f"{_line(100 + i, 5)}\n{hot}\n{_line(200 + i, 5)}") for i in range(300)]
    got = _cut(spark, rows)
    assert sum(n for _, _, n in got) == 299 and next(n for i, _, n in got if i == 0) == 0


def test_a_run_whose_lines_first_occur_apart_goes(spark):
    a, b = _line(1, 30), _line(2, 30)
    rows = [(1, a), (2, b)] + [(i, f"{a}\n{b}") for i in range(3, 9)]
    assert _cut(spark, rows) == sorted([(1, a, 0), (2, b, 0), (3, f"{a}\n{b}", 0)] + [(i, "", 2) for i in range(4, 9)], key=str)


def test_both_ends_of_a_repeated_run_go_with_it(spark):
    head, long, tail = _line(3, 10), _line(4, 55), _line(5, 10)
    whole = f"{head}\n{long}\n{tail}"
    # the long line occurs first on its own, the ends beside it only from document 2 on
    rows = [(1, f"own\n{long}\nelse"), (2, whole), (3, f"x\n{whole}\ny")]
    assert _cut(spark, rows) == sorted([(1, f"own\n{long}\nelse", 0), (2, f"{head}\n{tail}", 1), (3, "x\ny", 3)], key=str)


def test_dedup_plan_is_native(spark, small_dir):
    plan = QUERIES["op4_lines"](spark, small_dir)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "InArrow", "CartesianProduct", "NestedLoop"))


RULES = [urls.Rule("block", "net", "/"), urls.Rule("allow", "example.net", "/en/"), urls.Rule("block", "a.org", "/p"), urls.Rule("allow", "b.a.org", "")]
URLS = [
    "http://X.example.NET/en/1?q#f", "https://example.net/de/", "http://net", "http://net/", "http://notexample.net/en/", "ftp://b.a.org",
    "http://a.org/page", "http://b.a.org/page", "http://a.org/x", "no scheme", "", None, "http://", "x://y://z/?/", "http://a.org?/p", "http://example.net:80/en/",
]


def _brute(url):
    host, path = "", ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        for stop in "?#":
            rest = rest.split(stop, 1)[0]
        host, slash, path = rest.partition("/")
        host, path = host.lower(), slash + path
    fits = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: (len(r.host + r.path), len(r.host)), default=None)
    return host, path, best.host + best.path if best else None, best.verdict if best else "allow"


def test_url_rules(spark):
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(URLS)], "page_id long, url string").selectExpr("*", "'c' as host", "0 as judged")
    got = {r.page_id: tuple(r.judged) for r in urls.judge_urls(pages, RULES).collect()}
    assert got == {i: _brute(u) for i, u in enumerate(URLS)}
    assert urls.judge_urls(pages.limit(0), RULES).count() == 0


def _vectors():
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(12, 32))
    rows = [(i, (centres[i % 12] + rng.normal(size=32) * 0.03 * (i % 5)).tolist(), i % 3) for i in range(240)]
    rows += [(1000 + i, rows[5][1], rows[5][2]) for i in range(30)]  # copies
    rows += [(2000, None, 1), (2001, [0.0] * 32, 1), (2002, [float("nan")] + [1.0] * 31, 1), (2003, rows[0][1], None), (2004, [None] + [1.0] * 31, 1), (2005, [1.0, 2.0], 1), (2006, [2.0, 4.0], 1), (2007, [], 1), (None, rows[1][1], rows[1][2])]
    return rows


def _brute_vectors(rows):
    ok = [v is not None and len(v) > 0 and None not in v and np.isfinite(v).all() and any(v) and label is not None for _, v, label in rows]
    near = [[] for _ in rows]
    for i, (_, v, a) in enumerate(rows):
        for j, (_, w, b) in enumerate(rows):
            if i != j and ok[i] and ok[j] and a == b and len(v) == len(w) and np.dot(v, w) / (np.linalg.norm(v) * np.linalg.norm(w)) >= 0.98:
                near[i].append(j)
    label = list(range(len(rows)))
    for _ in rows:
        label = [min([label[i], *(label[j] for j in near[i])]) for i in range(len(rows))]
    out = []
    for i, (vec_id, _, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if label[j] == label[i] and rows[j][0] is not None]
        smallest = min(ids, default=None)
        out.append((vec_id, len(near[i]), smallest, vec_id is not None and vec_id == smallest))
    return sorted(out, key=str)


@pytest.mark.parametrize("tile", [2048, 7])
def test_near_vectors(spark, monkeypatch, tile):
    monkeypatch.setattr(vectors, "TILE", tile)
    rows = _vectors()
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").selectExpr("*", "'k' as key", "1 as _table")
    # the vectors as stored, in single precision
    stored = [(r.vec_id, r.embedding, r.label) for r in frame.collect()]
    got = sorted((tuple(r) for r in vectors.near_vectors(frame).collect()), key=str)
    assert got == _brute_vectors(stored)
    assert vectors.near_vectors(frame.limit(0)).count() == 0
