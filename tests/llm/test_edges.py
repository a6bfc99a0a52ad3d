"""Clashing names, null ids and long texts through the stages; bootstrapped patterns against
a plain version; workers that cannot import this package."""

import math
import os
import random
import re
import subprocess
import sys

from pyspark.sql import functions as F

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
NAMES = ["t", "row", "base", "marked", "spans", "kept", "word", "pattern", "i", "k", "key", "id", "fp", "bad_id", "bad_key",
         "kept_id", "_text_key", "_kept_id", "at", "x"]


def clashing(spark, rows):
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    for n in NAMES:
        df = df.withColumn(n, F.lit(f"own {n}"))
    return df


def own(df):
    return df.where(" AND ".join(f"`{n}` = 'own {n}'" for n in NAMES)).count()


LONG = " ".join(f"word{i % 977} mail" for i in range(30_000))


def test_redact_keeps_columns_of_any_name(spark):
    from cartwise.llm.pii import find_pii, redact
    rows = [(1, "write a@b.org or 10.0.0.1"), (None, "call +1 (423) 555-7713"), (None, None), (2, ""), (2, LONG + " a@b.org"), (2, "a@b.org")]
    df = clashing(spark, rows)
    out = redact(df)
    assert out.columns == df.columns and own(out) == len(rows)
    assert sorted((r.text or "none")[-30:] for r in out.collect()) == sorted(
        ["write [EMAIL] or [IP]", "call [PHONE]", "none", "none", (LONG + " [EMAIL]")[-30:], "[EMAIL]"])
    found = find_pii(df, keep=df.columns)
    assert found.count() == len(rows) and found.where("size(base) > 0").count() == 4


def test_stages_judge_rows_with_clashing_names_and_null_ids(spark):
    from cartwise.llm.decontaminate import decontaminate
    from cartwise.llm.simhash_dedup import near_dedup
    item = " ".join(f"benchmark{i} question" for i in range(12))
    rows = [(1, LONG), (2, LONG), (None, LONG), (None, f"see {item} here"), (3, "other text of its own"), (None, None), (4, "what now")]
    df = clashing(spark, rows)
    kept = near_dedup(df)
    assert kept.columns == df.columns and own(kept) == kept.count()
    assert sorted((r.doc_id or 0, (r.text or "")[:5]) for r in kept.collect()) == sorted(
        [(1, "word0"), (0, "see b"), (3, "other"), (0, ""), (4, "what ")])
    items = spark.createDataFrame([(7, item), (8, "What now?")], "item_id bigint, text string")
    clean = decontaminate(df, items)
    assert clean.columns == df.columns and own(clean) == clean.count() == len(rows) - 2
    assert clean.where("text LIKE 'see %' OR text = 'what now'").count() == 0


# ---- bootstrapped patterns -----------------------------------------------------

def plain_bootstrap(texts):
    """Spans of kind id by the rules of the docstring, with sets and loops. Seeds are emails."""
    from cartwise.llm.pii import MIN_SCORE, MIN_SUPPORT, MOST_CONTEXTS
    pairs, words = {}, []
    for d, text in enumerate(texts):
        toks = [(m.start(), m.group()) for m in re.finditer(r"\S+", text)]
        show = [re.sub("[0-9]+", "0", w.lower()) for _, w in toks]
        for i in range(2, len(toks)):
            at, w = toks[i]
            seed = re.fullmatch(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", w)
            inner = w if seed else re.sub(r"^[\W_]+|[\W_]+$", "", w)
            if not inner:
                continue
            p, x = f"{show[i - 2]} {show[i - 1]}", inner.lower()
            old = pairs.get((p, x), (False, False))
            pairs[p, x] = (old[0] or bool(seed), old[1] or bool(seed) or bool(re.search("[0-9]", w)))
            if not seed:
                words.append((d, at + w.index(inner), at + w.index(inner) + len(inner), p, bool(re.search("[0-9]", w))))
    seeds = {x for (_, x), (s, _) in pairs.items() if s}
    weights, good = {x: 1.0 for x in seeds}, {}
    while True:
        new = {}
        for p in {p for p, _ in pairs}:
            own_ = [(x, f[1]) for (q, x), f in pairs.items() if q == p]
            scores = []
            for rows in (own_, [(x, s) for x, s in own_ if s]):
                w = [weights.get(x, 0.0) for x, _ in rows]
                scores.append(sum(w) / len(w) if rows and sum(w) >= MIN_SUPPORT and sum(w) / len(w) >= MIN_SCORE else None)
            if scores != [None, None]:
                new[p] = scores
        if sum(s is not None for v in new.values() for s in v) <= sum(s is not None for v in good.values() for s in v):
            break
        good, told = new, {}
        for (p, x), (_, shaped) in pairs.items():
            if p in good and x not in seeds:
                s = max([v for v in (good[p][0], good[p][1] if shaped else None) if v is not None], default=None)
                if s is not None:
                    told.setdefault(x, []).append(s)
        weights = {x: 1.0 for x in seeds}
        for x, s in told.items():
            if sum(q == x for _, q in pairs) <= MOST_CONTEXTS * len(s):
                weights[x] = 1 - math.exp(sum(math.log1p(-min(v, 0.999999)) for v in s))
    return {(d, a, b) for d, a, b, p, digit in words if p in good and (good[p][0] is not None or digit)}


def test_bootstrap_equals_a_plain_version(spark, monkeypatch):
    from cartwise.llm import pii
    monkeypatch.setattr(pii, "SLICE_BYTES", 400)  # several slices on a small corpus
    rng = random.Random(3)
    found = 0
    for _ in range(3):
        word = lambda: rng.choice(["the", "of", "a", "and", "mail", "me", "id", "is", "for", "user", "no."])
        texts = []
        for i in range(90):
            parts = [word() for _ in range(rng.randint(0, 8))]
            for context in rng.sample(["reach me", "user id", "account number", "of the"], rng.randint(0, 2)):
                thing = rng.choice([f"n{i}@x{i}.org", f"n{i}@x{i}.org", f"n{i}@x{i}.org", f"u{rng.randrange(30)}", rng.choice(["the", "soon"])])
                parts += context.split() + [rng.choice(["", "(", "<"]) + thing if "@" not in thing else thing]
            texts.append(" ".join(parts + [word()]))
        want = plain_bootstrap(texts)
        rows = pii.find_pii(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"), keep=["doc_id"]).collect()
        got = {(r.doc_id, s.start, s.stop) for r in rows for s in r.spans if s.k == 4}
        assert got == want
        found += len(want)
    assert found > 20


# ---- executors without the package ---------------------------------------------

SCRIPT = """
import sys
sys.path.insert(0, {root!r})
from cartwise.session import get_spark
spark = get_spark("local[2]", conf={{"spark.checkpoint.dir": {shared!r}, "spark.sql.shuffle.partitions": "4",
                                    "spark.ui.showConsoleProgress": "false"}})
spark.sparkContext.setLogLevel("ERROR")
def missing(batches):
    import importlib.util
    import pyarrow as pa
    for b in batches:
        yield pa.RecordBatch.from_arrays([pa.array([importlib.util.find_spec("cartwise") is None] * b.num_rows)], ["gone"])
assert spark.range(3).mapInArrow(missing, "gone boolean").where("NOT gone").count() == 0
from cartwise.llm.queries import QUERIES
for name in {names!r}:
    assert QUERIES[name](spark, {sf!r}).count() > 0, name
    print("ran", name)
"""


def test_workers_need_no_copy_of_the_package(tmp_path, sf_dir):
    names = ["op1_substring_dedup", "op2_ann_tree", "op3_simhash_near_dedup", "op5_decontaminate", "op7_chat_format",
             "op8_quality", "op9_warc", "op11_ranked_search", "op13_periodic_runs"]
    script = tmp_path / "run.py"
    script.write_text(SCRIPT.format(root=ROOT, shared=f"file://{tmp_path}/shared", names=names, sf=sf_dir))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=550)
    assert out.returncode == 0, out.stderr[-3000:]
    assert out.stdout.count("ran ") == len(names)
