"""The ten operators against brute-force versions and on odd rows: nulls, empty and
long texts, ties, repeated rows, empty tables, extra columns with clashing names."""

import base64
import collections
import gzip
import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

LONG = " ".join(f"word{i % 977}" for i in range(40_000))
TEXTS = [(1, "a b c d e f g h i j k l m n o"), (2, "x a b c d e f g h i j k l m n o"), (3, None), (4, ""),
         (5, "  \t\n "), (6, LONG), (7, LONG + " end"), (7, LONG + " end"), (None, "a b c d e f g h i j k l m"),
         (8, "A B\x0bC d\x0ce\rf g h i j k l m n o"), (9, "é " * 30), (10, "one"), (11, "one"), (12, "one two")]
ODD = "doc_id bigint, text string"


def odd(spark):
    """The odd rows with extra columns named like the operators' own."""
    return (spark.createDataFrame(TEXTS, ODD).withColumn("id", F.lit("x")).withColumn("t", F.lit(1))
            .withColumn("ids", F.lit(None).cast("string")).withColumn("block", F.lit(2)).withColumn("row", F.lit(3))
            .withColumn("fp", F.lit(4)).withColumn("base", F.lit(5)).withColumn("spans", F.lit(6)))


def empty(spark):
    return odd(spark).limit(0)


# ---- 1 substring dedup -------------------------------------------------------

def removed_by_rule(rows, window):
    top = float("inf")
    split = [(top if i is None else i, (t or "").encode().split()) for i, t in rows]
    first = {}
    for i, w in split:
        for p in range(len(w) - window + 1):
            key = tuple(w[p:p + window])
            first[key] = min(first.get(key, top), i)
    out = []
    for i, w in split:
        gone = set()
        for p in range(len(w) - window + 1):
            if first[tuple(w[p:p + window])] < i:
                gone.update(range(p, p + window))
        out.append((len(w), len(gone), b" ".join(x for p, x in enumerate(w) if p not in gone).decode()))
    return out


def test_substring_dedup_on_odd_rows(spark):
    from cartwise.llm.substring_dedup import substring_dedup
    got = sorted(((-1 if r.id is None else r.id), r.n_words, r.n_removed, r.kept_text)
                 for r in substring_dedup(odd(spark)).collect())
    want = sorted(((-1 if i is None else i), *x) for (i, _), x in zip(TEXTS, removed_by_rule(TEXTS, 13)))
    assert got == want
    assert substring_dedup(empty(spark)).count() == 0


def test_substring_dedup_random_passages_many_blocks(spark):
    from cartwise.llm.substring_dedup import substring_dedup
    rnd = random.Random(5)
    passages = [[rnd.choice("abcdefgh") * rnd.randrange(1, 4) for _ in range(rnd.randrange(8, 40))] for _ in range(12)]
    rows = []
    for i in range(120):
        words = []
        for _ in range(rnd.randrange(0, 5)):
            words += [rnd.choice("uvwxyz") + str(rnd.randrange(50)) for _ in range(rnd.randrange(9))]
            p = rnd.choice(passages)
            words += p[rnd.randrange(3):len(p) - rnd.randrange(3)]
        rows.append((i, " ".join(words)))
    got = {r.id: (r.n_words, r.n_removed, r.kept_text)
           for r in substring_dedup(spark.createDataFrame(rows, ODD), block_bytes=500).collect()}
    want = {i: x for (i, _), x in zip(rows, removed_by_rule(rows, 13))}
    assert got == want and any(x[1] for x in want.values())


# ---- 2 nearest neighbours ------------------------------------------------------

def test_nearest_ties_nulls_and_recall(spark):
    from cartwise.llm.ann_tree import nearest
    rnd = np.random.default_rng(3)
    x = rnd.normal(size=(1500, 8)) * rnd.uniform(0.5, 2, size=(1500, 1))
    x[100:400] = x[100]  # one vector with many ids
    rows = [(int(i), [float(c) for c in v]) for i, v in enumerate(x)]
    bad = [(9000, None), (9020, [0.0] * 8), (9040, [float("nan")] + [1.0] * 7), (9060, [None] + [1.0] * 7), (9080, [1.0]), (9085, [2.0]),
           (9100, [float("inf")] + [1.0] * 7), (None, [1.0] * 8), rows[40], rows[40]]
    df = spark.createDataFrame(rows + bad, "vec_id bigint, embedding array<double>").withColumn("key", F.lit("k")) \
        .withColumn("v", F.lit("v"))
    got = collections.defaultdict(list)
    for r in nearest(df, F.expr("pmod(id, 20) = 0")).collect():
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    # vectors of another length meet only each other
    assert got.pop(9080) == [(1, 9085, 2.0)]
    assert sorted(got) == list(range(0, 1500, 20))
    hit = total = 0
    for q, found in got.items():
        found.sort()
        score = x @ x[q]
        score[q] = -np.inf
        true = np.lexsort((np.arange(len(x)), -score))[:20].tolist()
        assert [f[0] for f in found] == list(range(1, 21)) and q not in [f[1] for f in found]
        assert np.allclose([f[2] for f in found], score[[f[1] for f in found]], atol=1e-12)
        hit, total = hit + len(set(true) & {f[1] for f in found}), total + 20
    assert hit / total >= 0.9
    few = nearest(df.where("vec_id < 5"), F.expr("pmod(id, 20) = 0")).collect()
    assert len(few) == 4
    assert nearest(df.limit(0), F.expr("true")).count() == 0


def test_nearest_keeps_every_vector_of_an_id(spark):
    from cartwise.llm.ann_tree import nearest
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [5.0, 0.0]), (1, [9.0, 0.0]), (2, [2.0, 0.0]), (2, [2.0, 0.0])],
                               "vec_id bigint, embedding array<double>")
    got = {(r.query_id, r["rank"], r.vec_id, r.score) for r in nearest(df, F.expr("id = 0")).collect()}
    assert got == {(0, 1, 1, 9.0), (0, 2, 1, 5.0), (0, 3, 2, 2.0)}
    both = sorted((r["rank"], r.vec_id, r.score) for r in nearest(df, F.expr("id = 1")).collect())
    assert both == [(1, 1, 45.0), (1, 1, 45.0), (2, 2, 10.0), (2, 2, 18.0), (3, 0, 5.0), (3, 0, 9.0)]


# ---- 3 SimHash -----------------------------------------------------------------

def plain_simhash(text):
    w = (text or "").encode().lower().split()
    s = [b" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or ([b" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(x, 42) for x in s]
    return sum(1 << i for i in range(64) if sum(v >> i & 1 for v in h) * 2 > len(h))


def plain_components(prints):
    """Component (index of the first member) of each fingerprint at distance 2 or less."""
    f = np.array(prints, np.uint64)
    near = np.bitwise_count(f[:, None] ^ f[None, :]) <= 2
    root = np.arange(len(f))
    while True:
        new = np.where(near, root[None, :], len(f)).min(axis=1)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def test_simhash_on_odd_rows(spark):
    from cartwise.llm.simhash_dedup import near_dedup, simhash_components
    rows = [(i, t) for i, t in TEXTS if i is not None]
    want_print = {i: plain_simhash(t) for i, t in rows}
    ids = sorted(want_print)
    comp = plain_components([want_print[i] for i in ids])
    got = {r.id: (r.fp & (2 ** 64 - 1), r.component_id) for r in simhash_components(odd(spark)).collect()}
    assert all(got[i] == (want_print[i], ids[c]) for i, c in zip(ids, comp))
    kept = near_dedup(odd(spark).where("doc_id IS NOT NULL"))
    assert kept.columns == odd(spark).columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({ids[c] for c in comp})
    assert simhash_components(empty(spark)).count() == 0


def test_rows_are_judged_by_their_own_text(spark):
    """Null and repeated ids with different texts: only the rows that should go do."""
    from cartwise.llm.common import without
    from cartwise.llm.decontaminate import decontaminate
    from cartwise.llm.simhash_dedup import near_dedup
    rnd = random.Random(12)
    texts = [" ".join(rnd.choice(("oak", "elm", "fir", "ash", "yew", "bay", "box", "fig")) + str(rnd.randrange(99))
                      for _ in range(60)) for _ in range(4)]
    a, b, c, d = texts
    rows = [(None, a), (None, b), (None, b), (7, c), (7, d), (7, d), (9, a), (None, None), (None, "")]
    df = spark.createDataFrame(rows, ODD).withColumn("key", F.lit("x")).withColumn("component", F.lit(1))
    order = lambda got: sorted((str(r.doc_id), str(r.text)) for r in got.collect())
    kept = near_dedup(df)
    assert kept.columns == df.columns
    # the null and the empty text share fingerprint zero: one of the two stays
    assert [r for r in order(kept) if r[1] not in ("", "None")] == sorted([("9", a), ("None", b), ("7", c), ("7", d)])
    assert kept.count() == 5
    items = spark.createDataFrame([(1, b), (2, d)], "item_id bigint, text string")
    assert order(decontaminate(df, items)) == sorted((str(i), str(t)) for i, t in rows if t not in (b, d))
    bad = spark.createDataFrame([(None, a), (7, c)], ODD).select(F.col("doc_id").alias("id"), F.xxhash64("text").alias("key"))
    assert order(without(df, bad, "doc_id", "text")) == sorted(
        (str(i), str(t)) for i, t in rows if (i, t) not in ((None, a), (7, c)))


@pytest.mark.parametrize("cap", [2, 1024])
def test_links_over_dense_groups(spark, cap):
    """Groups around common fingerprints, also beyond the cap (the two-bit index)."""
    from cartwise.llm.graph import components
    from cartwise.llm.simhash_dedup import links
    rnd = random.Random(cap)
    prints = set()
    for _ in range(6):
        center = rnd.getrandbits(64)
        prints.add(center)
        for _ in range(25):
            center ^= 1 << rnd.randrange(64)
            prints.add(center ^ (1 << rnd.randrange(64)))
    prints |= {rnd.getrandbits(64) for _ in range(200)}
    ids = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in ids]
    root = plain_components(ids)
    got = {r.node: r.component for r in components(
        links(spark.createDataFrame([(s,) for s in signed], "fp bigint"), cap=cap)).collect()}
    groups = collections.defaultdict(set)
    for s, c in zip(signed, root):
        groups[c].add(s)
    for members in groups.values():
        assert {got.get(m, m) for m in members} == {min(members)}


def test_components_of_a_chain(spark):
    from cartwise.llm.graph import components
    edges = [(i, i + 1) for i in range(60)] + [(100, 101), (101, 101), (100, 101)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}


# ---- 4 BPE ---------------------------------------------------------------------

def bpe_path():
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def test_bpe_equals_the_library(spark):
    from tokenizers import Tokenizer
    from cartwise.llm.bpe import Encoder, Vocabulary
    lib = Tokenizer.from_file(bpe_path())
    lib.no_truncation()
    lib.no_padding()
    rnd = random.Random(2)
    texts = ["", "a" * 3000, " <|endoftext|> a<|endoftext|>", "  \n\n x \t　y\x1c z\x85\xa0", "don't we'll I'm 12a"]
    texts += ["".join(chr(c) for c in range(s, s + 50) if not 0xD800 <= c < 0xE000) for s in range(0, 0x3000, 50)]
    texts += ["".join(rnd.choice(" \n\tstdremvl'09abAB.,!é") for _ in range(rnd.randrange(60))) for _ in range(500)]
    with open(bpe_path(), encoding="utf-8") as f:
        got = Encoder(Vocabulary(f.read()), cache_size=50).encode(texts)
    want = lib.encode_batch(texts, add_special_tokens=False)
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [w.ids for w in want]


def test_bpe_round_trip_on_odd_rows(spark):
    from cartwise.llm.bpe import decode, round_trip
    rows = round_trip(odd(spark), bpe_path()).select("text", "ids", "n_tokens", "decoded", "block").collect()
    assert len(rows) == len(TEXTS)
    assert all(r.decoded == (r.text or "") and r.n_tokens * 4 == len(r.ids) and r.block == 2 for r in rows)
    assert round_trip(empty(spark), bpe_path()).count() == 0
    ids = spark.createDataFrame([(bytearray(np.array([50256, 99999999, 220], "<u4").tobytes()),), (None,)], "ids binary")
    assert sorted(r.decoded for r in decode(ids, bpe_path()).collect()) == ["", "<|endoftext|> "]


def test_bpe_round_trip_is_encode_then_decode_in_one_worker(spark):
    from cartwise.llm.bpe import decode, encode, round_trip
    df = odd(spark).selectExpr("*", "'x' AS decoded", "7 AS n_tokens")
    both = decode(encode(df, bpe_path()), bpe_path()).selectExpr("text", "ids", "octet_length(ids) DIV 4", "decoded", "block")
    once = round_trip(df, bpe_path())
    key = lambda r: tuple(map(str, r))
    assert sorted(map(key, once.select("text", "ids", "n_tokens", "decoded", "block").collect())) == sorted(map(key, both.collect()))
    assert once._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1  # a second one is a second worker a task


# ---- 5 decontamination -----------------------------------------------------------

def test_matches_exact_edited_and_clean(spark):
    from cartwise.llm.decontaminate import decontaminate, matches, normalised
    rnd = random.Random(4)
    item = " ".join("".join(rnd.choice("abcdefghij") for _ in range(rnd.randrange(2, 9))) for _ in range(40))
    edits = list(item)
    for _ in range(15):
        edits[rnd.randrange(len(edits))] = "q"
    far = list(item)
    for p in range(0, len(far), 3):
        far[p] = "z"
    other = " ".join("".join(rnd.choice("klmnopqrst") for _ in range(5)) for _ in range(90))
    filler = " ".join("".join(rnd.choice("uvwxyz") for _ in range(6)) for _ in range(15_000))
    docs = [(1, f"{other} {item} {other}"), (2, f"{other} {''.join(edits)}"), (3, "".join(far)), (4, other), (5, None),
            (6, ""), (7, f"{filler} {item.upper().replace(' ', '!! ')} {filler}"), (8, item[:len(item) // 2]), (1, item)]
    df = spark.createDataFrame(docs, ODD).withColumn("item_id", F.lit("c")).withColumn("id", F.lit(0))
    items = spark.createDataFrame([(1, item), (2, None), (3, "Short one!"), (4, item), (5, ""), (6, "... --")], "item_id bigint, text string")
    rows = matches(df, items).collect()
    assert sorted({(r.id, r.item_id) for r in rows}) == [(i, j) for i in (1, 2, 7) for j in (1, 4)]
    text = normalised(docs[6][1])
    span = next(r for r in rows if r.id == 7)
    assert text[span.start:span.stop] == normalised(item) and span.edits == 0
    assert sorted(r.doc_id for r in decontaminate(df, items).collect()) == [3, 4, 5, 6, 8]
    assert matches(df.limit(0), items).count() == 0 and matches(df, items.limit(0)).count() == 0


def test_match_set_equals_plain_search(spark, monkeypatch):
    from cartwise.llm import decontaminate as D
    rnd = random.Random(9)
    word = lambda: "".join(rnd.choice("abcdefg") for _ in range(rnd.randrange(1, 7)))
    items = [" ".join(word() for _ in range(n)) for n in (1, 2, 3, 5, 9, 12, 15, 20, 30) for _ in range(2)]
    docs = []
    for i in range(200):
        parts = [word() for _ in range(rnd.randrange(30))]
        for item in rnd.sample(items, rnd.randrange(3)):
            t = list(item)
            for _ in range(rnd.randrange(0, max(1, len(t) // 7))):
                p = rnd.randrange(len(t))
                t[p:p + 1] = rnd.choice([[], ["x"], [t[p], "y"]])
            parts.insert(rnd.randrange(len(parts) + 1), "".join(t))
        docs.append((i, rnd.choice([" ", " .\n", "  "]).join(parts)))

    def distance(item, text):
        last = [0] * (len(text) + 1)
        for i, c in enumerate(item, 1):
            now = [i]
            for j, d in enumerate(text, 1):
                now.append(min(last[j] + 1, now[-1] + 1, last[j - 1] + (c != d)))
            last = now
        return min(last)

    want = set()
    for i, doc in docs:
        text = D.normalised(doc)
        for n, item in enumerate(map(D.normalised, items)):
            if len(item) < D.MIN_CHARS:
                if f" {item} " in f" {text} ":
                    want.add((i, n, 0))
            elif text and (d := distance(item, text)) <= int(len(item) * D.EDIT_RATE):
                want.add((i, n, d))
    df = spark.createDataFrame(docs, ODD)
    bench = spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string")
    rows = D.matches(df, bench).collect()
    assert {(r.id, r.item_id, r.edits) for r in rows} == want and len(want) > 100 and len(rows) == len(want)
    texts = dict(docs)
    for r in rows:
        assert distance(D.normalised(items[r.item_id]), D.normalised(texts[r.id])[r.start:r.stop]) == r.edits
    monkeypatch.setattr(D, "ITEM_BYTES", 120)  # many blocks give the same
    assert {(r.id, r.item_id, r.edits) for r in D.matches(df, bench).collect()} == want


def test_aligned_is_the_edit_distance(spark):
    from cartwise.llm.decontaminate import aligned
    rnd = random.Random(8)
    for _ in range(60):
        a = "".join(rnd.choice("abc") for _ in range(rnd.randrange(1, 12)))
        b = "".join(rnd.choice("abc") for _ in range(rnd.randrange(1, 30)))
        last = [0] * (len(b) + 1)
        for i, c in enumerate(a, 1):
            now = [i]
            for j, d in enumerate(b, 1):
                now.append(min(last[j] + 1, now[-1] + 1, last[j - 1] + (c != d)))
            last = now
        assert aligned(a, b, 99)[0] == min(last)


# ---- 6 URL filters -----------------------------------------------------------------

URLS = ["http://A.Example.COM/en/x?q", "https://www.example.com/en/", "http://example.com", "http://example.com/e", None, "",
        "no-scheme/en/", "ftp://x.net/es/1#f", "http://net/fr/", "http://notnet/fr/", "http://a.b.c.com#x", "://com/",
        "http://http://com/", "http://" + "a." * 500 + "com/" + "p" * 2000, "http://example.com/en/", "http://example.com/en/"]


def test_url_rules_by_brute_force(spark):
    from cartwise.llm.queries import URL_RULES
    from cartwise.llm.url_filter import url_filter
    df = spark.createDataFrame(list(enumerate(URLS)), "page_id bigint, url string").withColumn("key", F.lit(1)) \
        .withColumn("entry", F.lit("z")).withColumn("host", F.lit("mine"))
    rules = spark.createDataFrame(URL_RULES + [URL_RULES[0]], "entry string, verdict string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter(df, rules).collect()}
    for i, url in enumerate(URLS):
        rest = url.partition("://")[2] if url and "://" in url else ""
        host = re.match(r"[^/?#]*", rest).group()
        path = re.match(r"[^?#]*", rest[len(host):]).group()
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
        fits = [(len(e), e, v) for e, v in URL_RULES for h, p in [(e[:e.index("/")], e[e.index("/"):])]
                if (host == h or host.endswith("." + h)) and path.startswith(p)]
        want = max(fits)[1:] if fits else (None, "allow")
        assert got[i] == (host, path, *want), url
    assert url_filter(df.limit(0), rules).count() == 0
    assert {r.verdict for r in url_filter(df, rules.limit(0)).collect()} == {"allow"}


def test_url_filter_bloom_has_no_false_negative_and_join_no_false_positive(spark):
    from cartwise.llm.url_filter import url_filter
    df = spark.range(4000).select(F.col("id").alias("page_id"), F.concat(F.lit("http://h"), "id", F.lit(".org/a/"), "id")
                                  .alias("url"))
    rules = spark.range(0, 4000, 3).select(F.concat(F.lit("h"), "id", F.lit(".org/a/")).alias("entry"),
                                           F.lit("block").alias("verdict"))
    got = {r.page_id: r.verdict for r in url_filter(df, rules).collect()}
    assert got == {i: "block" if i % 3 == 0 else "allow" for i in range(4000)}


# ---- 7 chat ---------------------------------------------------------------------------

def test_chat_reads_back(spark):
    from cartwise.llm.chat_format import CONTROL, escape, format_turns, read_back, unescape
    for s in ["<s>", "<\\s>", "<\\\\s>[INST][\\/INST]", "<|im_start|><|im_sep|><\\|im_end|>", "<<s>>[[INST]]", "\\<s>"]:
        assert unescape(escape(s)) == s and not any(c in escape(s) for c in CONTROL)
    turns = [(1, 0, "user", "hi"), (1, 1, "assistant", "</s>[INST] ok [/INST]"), (1, 2, "assistant", "é<|im_end|>"),
             (2, 0, None, None), (2, 1, "assistant", None), (3, 5, "assistant", ""), (3, 5, "assistant", "x"),
             (4, 0, "a\nb<s>", "t" * 50_000), (5, 1, "user", "r"), (5, 1, "user", "r"), (None, 0, "assistant", "n")]
    df = spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string").withColumn("ids", F.lit(1)) \
        .withColumn("start", F.lit(2))
    rows = {r.conv_id: r for r in read_back(format_turns(df, bpe_path()), bpe_path()).collect()}
    convs = collections.defaultdict(list)
    for c, t, role, text in turns:
        convs[c].append((t, role or "", text or ""))
    assert set(rows) == set(convs)
    for c, ts in convs.items():
        ts.sort()
        loss = "".join(x for _, r, x in ts if r == "assistant")
        said = "".join(f"{r}\n{x}\n" for _, r, x in ts)
        r = rows[c]
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == (
            len(ts), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert read_back(format_turns(df.limit(0), bpe_path()), bpe_path()).count() == 0


# ---- 8 quality -------------------------------------------------------------------------

def test_quality_on_held_out_rows_and_odd_rows(spark):
    from cartwise.llm.queries import op8_quality
    from cartwise.llm.quality import score_quality
    sf = "/root/testdata/sf0.01"
    rows = {r.doc_id: r for r in op8_quality(spark, sf).collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    held = [(rows[i].score, y, rows[i].predicted) for i, y in labels.items() if rows[i].held_out]
    pos, neg = [s for s, y, _ in held if y], [s for s, y, _ in held if not y]
    assert np.mean([[a > b for b in neg] for a in pos]) > 0.95
    assert np.mean([p == y for _, y, p in held]) > 0.95
    few = spark.createDataFrame([(1, 1, 9), (2, 0, 9), (2, 1, 9), (None, 1, 9), (4, None, 9)],
                                "doc_id bigint, quality int, text int")
    scored = score_quality(odd(spark), few).collect()
    assert len(scored) == len(TEXTS) and all(0 <= r.score <= 1 for r in scored)
    assert score_quality(empty(spark), few).count() == 0
    assert {r.score for r in score_quality(odd(spark), few.limit(0)).collect()} and \
        all(r.score > 0.3 for r in score_quality(odd(spark), few.limit(0)).collect())


# ---- 9 WARC ----------------------------------------------------------------------------

PAGES = [(1, "http://a", "x"), (2, "u\nv", "x"), (3, None, None), (4, "", ""), (5, "é", "y" * 100_000),
         (6, "é", "y" * 100_000), (7, "a", "<html>\r\n\r\n"), (8, "a" * 5000, "z"), (9, "w", "é")]


def test_warc_round_trip(spark, tmp_path):
    from cartwise.llm.warc import archive, key_of, read_archive
    df = spark.createDataFrame(PAGES, "page_id bigint, url string, html string").withColumn("payload", F.lit(1)) \
        .withColumn("key", F.lit("k"))
    path = archive(df, f"file://{tmp_path}/all")
    rows = {r.key: r for r in read_archive(spark, path).withColumn("refers", key_of("refers_to")).collect()}
    first = {h or "": i for i, _, h in PAGES}
    for i, _, html in PAGES:
        raw, r = (html or "").encode(), rows[i]
        assert r.payload_length == len(raw)
        assert r.payload_digest == base64.b32encode(hashlib.sha1(raw).digest()).decode()
        assert (r.record_type, r.refers) == (("response", None) if first[html or ""] == i else ("revisit", first[html or ""]))
        assert r.payload is None if r.record_type == "revisit" else bytes(r.payload) == raw
    only = read_archive(spark, path, "record_type string, key bigint").where("record_type = 'revisit'")
    assert sorted(r.key for r in only.collect()) == [1, 3, 5]
    files = list((tmp_path / "all").glob("*.warc.gz"))
    assert sum(gzip.open(f).read().count(b"WARC/1.1\r\n") for f in files) == len(PAGES)
    assert read_archive(spark, archive(df.limit(0), f"file://{tmp_path}/none")).count() == 0
    least = archive(df, f"file://{tmp_path}/least", least_bytes=1000)
    assert sorted(r.key for r in read_archive(spark, least).where("record_type = 'revisit'").collect()) == [5]


def test_warc_reads_plain_gzip_members_and_ignores_unlisted_files(spark, tmp_path):
    from cartwise.llm.warc import archive, read_archive, record_bytes
    rec = {"record_type": "response", "record_id": "<urn:x-record:1>", "target_uri": "u", "key": 1, "date": "d",
           "payload_digest": "D", "payload_length": 3, "refers_to": None, "payload": b"abc"}
    (tmp_path / "foreign").mkdir()
    with open(tmp_path / "foreign" / "x.warc.gz", "wb") as f:
        for k in range(5):
            f.write(gzip.compress(record_bytes(rec | {"key": k, "payload": b"abc" * 3000 * k, "payload_length": 9000 * k})))
    got = {r.key: r for r in read_archive(spark, f"file://{tmp_path}/foreign").collect()}
    assert sorted(got) == [0, 1, 2, 3, 4] and bytes(got[4].payload) == b"abc" * 12000
    df = spark.createDataFrame(PAGES, "page_id bigint, url string, html string")
    path = archive(df, f"file://{tmp_path}/listed")
    (tmp_path / "listed" / "part-lost.warc.gz").write_bytes(gzip.compress(record_bytes(rec)))
    assert read_archive(spark, path).count() == len(PAGES)


# ---- 10 PII ----------------------------------------------------------------------------

BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (2 if i % 2 else 1)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def plain_spans(text):
    out = []
    for k, (kind, rx) in enumerate(BASE.items()):
        for m in re.finditer(rx, text):
            digits = re.sub("[^0-9]", "", m.group())
            good = {"email": True, "ip": kind != "ip" or all(int(p) <= 255 for p in m.group().split(".")),
                    "card": 14 <= len(digits) <= 19 and luhn(digits), "phone": 10 <= len(digits) <= 15}[kind]
            if good:
                out.append((m.start(), k, m.end()))
    return sorted(out)


HARD = ["a@b.c_d@e.f", "a@b.c.d@e.f..g@h.i", "1.2.3.4.5.6.7.8", "999.1.1.1 0255.1.1.1 000000300.1.1.1", "1" * 3000,
        "4111 1111 1111 1111", "4111-1111-1111-1111 x +1 (423) 555-7713 (", "+1--------", "\x01a@b.c\x02\x01", "a" * 20000,
        ("a." * 5000) + "@x.y", "é 10.0.0.1é", "x@" + ".".join(["a"] * 6000), "1 " * 9000, "😀 a@b.co 1.1.1.1", None, "",
        "0" * 16, "+123456789012345678", "1.2.3", "a@@b.c", "%@-.-", "+1(555)-5555555 +1 555 555 5555"]


def test_base_spans_equal_plain_matching(spark):
    from cartwise.llm.pii import find_pii
    df = spark.createDataFrame(list(enumerate(HARD)), ODD).withColumn("row", F.lit(1)).withColumn("tokens", F.lit(2)) \
        .withColumn("t", F.lit(3))
    got = {r.doc_id: [(s.start, s.k, s.stop) for s in r.base] for r in find_pii(df, keep=["doc_id"]).collect()}
    assert got == {i: plain_spans(t or "") for i, t in enumerate(HARD)}
    assert find_pii(df.limit(0), keep=["doc_id"]).count() == 0


def test_patterns_learned_from_seeds_find_what_the_base_misses(spark):
    from cartwise.llm.pii import KINDS, find_pii, redact
    docs = [(i, f"filler words mail me {n}{i}@x{i}.org today") for i, n in enumerate(["ann", "bob", "cy", "dee", "eve"])]
    docs += [(10, "please mail me user77.example soon"), (11, "see part 77a of it"), (12, "mail me"), (13, None)]
    df = spark.createDataFrame(docs, ODD)
    spans = {r.doc_id: [(s.start, KINDS[s.k], s.stop) for s in r.spans] for r in find_pii(df, keep=["doc_id"]).collect()}
    assert spans[10] == [(15, "id", 29)] and spans[11] == [] and spans[12] == [] and spans[13] == []
    out = {r.doc_id: r.text for r in redact(df).collect()}
    assert out[0] == "filler words mail me [EMAIL] today" and out[10] == "please mail me [ID] soon"
    assert out[11] == docs[6][1] and out[13] is None


def spans_of(spark, docs):
    from cartwise.llm.pii import KINDS, find_pii
    rows = find_pii(spark.createDataFrame(docs, ODD), keep=["doc_id"]).collect()
    return {r.doc_id: [(s.start, KINDS[s.k], s.stop) for s in r.spans] for r in rows}


def test_whole_spans_without_digits_or_with_spaces_are_seeds(spark):
    # emails without a digit, and words without one behind their pattern
    docs = [(i, f"you can reach me at {n}@corp.com, thanks") for i, n in enumerate(["ann.lee", "bob", "cy", "dee", "eve"])]
    docs += [(10, "or reach me at  (skype:ann-lee) now"), (11, "meet me there"), (12, "at me at")]
    # spaced phones: five distinct ones; a copy adds nothing
    docs += [(20 + i, f"é😀 call my desk +1 (743) 555-38{i}4 any time") for i in range(5)]
    docs += [(30, "call  My desk x77-12, ok"), (31, "(743) 555-3 thing 8")]
    # a seed that follows a word directly
    docs += [(40 + i, f"now send to:z{n}@corp.com") for i, n in enumerate("abcde")] + [(50, "send to: handle")]
    # found words lead to the other patterns they stand behind, and those to more words
    docs += [(200 + i, f"mail them at {chr(97 + i % 26) * (1 + i // 26)}@corp.com today") for i in range(100)]
    words = ["qq", "rr", "ss", "tt", "vv", "ww", "xx", "yy", "zz"]
    docs += [(60 + i, f"mail them at {w} today") for i, w in enumerate(words)]
    docs += [(80 + i, f"my nick is {w} ok") for i, w in enumerate(words + ["uu"])]
    # three spaced phones in one place only are too few among words
    docs += [(100 + i, f"this is the +1 (743) 555-99{i}4") for i in range(3)] + [(110, "this is the end is the day is the sea")]
    got = spans_of(spark, docs)
    text = dict(docs)
    found = {i: [text[i][a:b] for a, k, b in s if k == "id"] for i, s in got.items()}
    want = {10: ["skype:ann-lee"], 30: ["x77-12"], 50: ["handle"], 89: ["uu"],
            **{60 + i: [w] for i, w in enumerate(words)}, **{80 + i: [w] for i, w in enumerate(words)}}
    assert {i: f for i, f in found.items() if f} == want


def test_a_pattern_too_wide_for_words_still_finds_tokens_with_a_digit(spark):
    docs = [(i, f"write to {n}@corp.com") for i, n in enumerate("abcde")]
    docs += [(10, "write to user7 now"), (11, "write to them"), (12, "write to us"), (13, "write to you")]
    assert {i: s for i, s in spans_of(spark, docs).items() if i > 9} == {10: [(9, "id", 14)], 11: [], 12: [], 13: []}
