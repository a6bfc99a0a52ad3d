"""Quality rules and periodic runs against plain versions and on odd rows."""

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

LONG = " ".join(f"word{i % 977}" for i in range(40_000))
TEXTS = [(1, "a b c d e f g h i j k l m n o"), (2, None), (3, ""), (4, "  \t\n "), (5, LONG), (6, "é " * 30), (7, "one"),
         (7, "one"), (None, "x y x y x y x y x y z"), (8, "A B\x0bC d\x0ce\rf\n\nA B\n A B\nA B"), (9, "- a\n* b\n• c\n..."),
         (10, "the cat and the dog " * 9 + "$$$ %%% ###")]
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def odd(spark):
    df = spark.createDataFrame(TEXTS, "doc_id bigint, text string")
    for name in ("id", "t", "c", "ws", "ls", "h", "hs", "n_words", "runs", "counts", "failed", "kept"):
        df = df.withColumn(name, F.lit("x"))
    return df


def plain_counts(text):
    from cartwise.llm.quality_rules import STOP_WORDS, SYMBOLS
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    places = {}
    for i in range(len(w) - 7):
        places.setdefault(tuple(w[i:i + 8]), []).append(i)
    covered = {p for v in places.values() if len(v) > 1 for i in v for p in range(i, i + 8)}
    stops = {y for x in STOP_WORDS for y in (x, x.capitalize())}
    return {"n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": sum(text.count(c) for c in SYMBOLS),
            "n_digits": sum(text.count(c) for c in "0123456789"), "n_stop_words": sum(x in stops for x in w),
            "n_lines": len(lines), "n_dup_lines": len(lines) - len(set(lines)),
            "n_bullet_lines": sum(x[:2] in ("- ", "* ") or x[:1] == "•" for x in lines),
            "n_ellipsis_lines": sum(x.endswith(("...", "…")) for x in lines), "n_repeat_words": len(covered)}


def plain_failed(counts):
    from cartwise.llm.quality_rules import RULES
    out = []
    for name, num, den, least, most in RULES:
        n, d = counts[num], 1 if den == "1" else counts[den]
        if d and ((least is not None and n * 1000 < least * d) or (most is not None and n * 1000 > most * d)):
            out.append(name)
    return out


def test_rules_equal_plain_counts(spark):
    from cartwise.llm.quality_rules import BASE_RULES, judge
    rng = random.Random(4)
    texts = list(TEXTS)
    for i in range(300):
        words = [rng.choice(["the", "And", "a", "b$", "12", "..", "\n", "\n- x", "é…", "w%d" % rng.randrange(9)])
                 for _ in range(rng.randrange(60))]
        texts.append((100 + i, rng.choice([" ", "  ", "\n", "\t "]).join(words * rng.choice([1, 1, 2, 5]))))
    rows = judge(spark.createDataFrame(texts, "doc_id bigint, text string")).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = plain_counts(r.text)
        assert r.quality_rules.counts.asDict() == want, r.text
        assert r.quality_rules.failed == plain_failed(want)
        assert r.quality_rules.base_failed == any(f in BASE_RULES for f in r.quality_rules.failed)


def test_rules_keep_clashing_columns_and_empty_tables(spark):
    from cartwise.llm.quality_rules import judge, keep_by_rules
    df = odd(spark)
    out = judge(df)
    assert out.columns == df.columns + ["quality_rules"] and out.count() == len(TEXTS)
    assert out.where("n_words = 'x' AND ws = 'x'").count() == len(TEXTS)
    assert keep_by_rules(df).columns == df.columns
    assert judge(df.limit(0)).count() == 0


def test_a_rule_table_of_ones_own(spark):
    from cartwise.llm.quality_rules import judge, keep_by_rules
    rules = [("short", "n_words", "1", None, 3_000)]
    assert sorted(r.text for r in keep_by_rules(odd(spark), rules=rules).select(F.coalesce("text", F.lit("")).alias("text")).collect()) \
        == sorted(["", "", "  \t\n ", "one", "one"])
    assert {tuple(r.failed) for r in judge(odd(spark), rules=rules, base=()).select("quality_rules.failed").collect()} == {(), ("short",)}
    assert judge(odd(spark), rules=[], base=()).where("size(quality_rules.failed) > 0").count() == 0


def test_rules_are_one_projection_without_user_functions(spark):
    from cartwise.llm.quality_rules import judge
    plan = judge(odd(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
    tree = judge(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))._jdf.queryExecution().optimizedPlan()
    assert tree.toString().count("Project") == 1


def test_rules_keep_clean_documents(spark):
    from cartwise.llm.quality_rules import judge
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    r = judge(docs).join(labels, "doc_id").where("NOT quality_rules.base_failed").groupBy("quality").agg(
        F.avg((F.size("quality_rules.failed") > 0).cast("int")).alias("out"))
    out = {x.quality: x.out for x in r.collect()}
    assert out[1] < 0.02 and out[0] > 0.9


# ---- periodic runs -----------------------------------------------------------

def plain_runs(w):
    found = {}
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > i and j - i + q >= max(6, 4 * q):
                found.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted(((i, n, q) for (i, n), q in found.items()), key=lambda r: (r[0], r[2]))


def plain_collapse(w, runs):
    gone = {p for i, n, q in runs for p in range(i + q, i + n)}
    return " ".join(x for p, x in enumerate(w) if p not in gone)


def random_words(rng, n, letters):
    out = []
    while len(out) < n:
        if rng.random() < 0.4:
            unit = [f"w{rng.randrange(letters)}" for _ in range(rng.randint(1, 40))]
            out += (unit * rng.randint(1, 8))[:rng.randint(1, 200)]
        else:
            out.append(f"w{rng.randrange(letters)}")
    return out[:n]


def test_transform_is_an_exact_convolution():
    from cartwise.llm.periodic_runs import PRIME, Transform, squared_differences
    rng = np.random.default_rng(1)
    for s in (1, 2, 4, 32, 256):
        blocks, windows = rng.integers(0, 1000, (5, s)), rng.integers(0, 1000, (5, 2 * s - 1))
        windows[0, s // 2:s // 2 + s] = blocks[0]
        got = squared_differences(blocks.astype(np.uint64), windows.astype(np.uint64), Transform(2 * s))
        want = [[int(((b - w[e:e + s]) ** 2).sum()) % PRIME for e in range(s)] for b, w in zip(blocks, windows)]
        assert got.tolist() == want and got[0, s // 2] == 0


def test_runs_equal_plain_search():
    from cartwise.llm.periodic_runs import _runs_of_slice
    rng = random.Random(7)
    texts = [random_words(rng, rng.randint(0, 260), rng.choice([1, 2, 3, 5, 60])) for _ in range(500)]
    texts += [["a"] * 5000, ["a", "b"] * 2500, (["a"] * 99 + ["b"]) * 30, [str(i % 613) for i in range(4000)]]
    batch = _runs_of_slice(pa.array(range(len(texts))), [" ".join(w).encode() for w in texts])
    total = 0
    for w, r in zip(texts, batch.to_pylist()):
        want = plain_runs(w)
        assert [(x["start"], x["length"], x["period"]) for x in r["runs"]] == want
        assert (r["n_words"], r["collapsed"]) == (len(w), plain_collapse(w, want))
        total += len(want)
    assert total > 300


def test_runs_on_odd_rows(spark):
    from cartwise.llm.periodic_runs import periodic_runs
    got = periodic_runs(odd(spark))
    assert got.columns == ["id", "n_words", "runs", "collapsed"]
    key = lambda r: (-1 if r[0] is None else r[0], str(r[1:]))
    words = [(i, (t or "").encode().split()) for i, t in TEXTS]
    want = [(i, len(w), [] if t == LONG else plain_runs(w)) for (i, w), (_, t) in zip(words, TEXTS)]
    n = 40_000
    want = [(i, n, [(0, n, 977)]) if i == 5 else (i, k, r) for i, k, r in want]
    assert sorted([(r.id, r.n_words, [tuple(x) for x in r.runs]) for r in got.collect()], key=key) == sorted(want, key=key)
    assert periodic_runs(odd(spark).limit(0)).count() == 0


def test_op13_query_equals_plain_version(spark, sf_dir):
    from cartwise.llm.queries import op13_periodic_runs
    docs = {}
    for r in pq.read_table(f"{sf_dir}/documents.parquet").to_pylist():
        w = WORD.findall(r["text"] or "")
        h = zlib.crc32(str(r["doc_id"]).encode())
        g, n = h // 10, len(w)
        if n > 6000 and h % 10:
            continue  # the plain search is quadratic
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
        if n <= 3000:
            docs[r["doc_id"]] = w
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    seen = 0
    for r in op13_periodic_runs(spark, sf_dir).collect():
        if r.doc_id not in docs:
            continue
        w = docs[r.doc_id]
        runs = plain_runs(w)
        best = max(runs, key=lambda x: (x[1] / x[2], -x[0], -x[2]), default=(None,) * 3)
        assert (r.n_runs, r.start, r.length, r.period) == (len(runs), *best)
        assert r.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        assert r.runs_sha256 == sha("".join(f"{i},{n},{q}\n" for i, n, q in runs))
        assert r.collapsed_sha256 == sha(plain_collapse(w, runs))
        seen += len(runs)
    assert seen > 10 and len(docs) > 150


@pytest.mark.parametrize("text", ["a " * 6, "a b " * 4, "a " * 5, "a b " * 3 + "a", "a b c " * 4])
def test_least_lengths(text):
    from cartwise.llm.periodic_runs import _runs_of_slice
    got = _runs_of_slice(pa.array([1]), [text.encode()]).to_pylist()[0]["runs"]
    assert [(x["start"], x["length"], x["period"]) for x in got] == plain_runs(text.split())
