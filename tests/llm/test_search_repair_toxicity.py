"""Lexical search, conversation repair and toxicity against brute force, and on
nulls, empty and long texts, ties, repeated rows, clashing columns, empty tables."""
import hashlib
import math
import random
import re
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tabclass.llm import conversation_repair as repair_module
from tabclass.llm import lexical_search as search_module
from tabclass.llm import toxicity as toxicity_module
from tabclass.llm.conversation_repair import Audits, Conversation, audits, damage, repaired
from tabclass.llm.lexical_search import Heap, Segment, build_index, encode, impacts, search, search_segment, segment_terms
from tabclass.llm.toxicity import ExampleIndex, fit_curve, scored, term_hashes, toxicity, train

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def clash(df, *columns):
    for c in columns:
        df = df.withColumn(c, F.lit("clash"))
    return df


# ------------------------------------------------------------------ search
def corpus(seed, n):
    rng = random.Random(seed)
    vocab = [f"w{i}é" if i % 3 else f"W{i}" for i in range(60)]
    text = lambda k: " ".join(rng.choice(vocab[: rng.randrange(1, 60)]) for _ in range(k))
    rows = [(i * 7 % 1000, rng.choice([text(rng.randrange(0, 60)), text(3), text(400)])) for i in range(n)]
    rows += [(None, text(20)), (None, None), (5003, ""), (5009, "w1é " * 70_000), (5010, "x" * 100_000), rows[3], rows[3]]
    return rows, [text(rng.randrange(1, 9)) + rng.choice([" W3", " zz", " w1é w1é", ""]) for _ in range(40)]


def ranked(docs, query, k=20):
    found = [terms(t) for _, t in docs]
    n, total = sum(map(bool, found)), sum(map(len, found))
    counts = [Counter(t) for t in found]
    df = Counter(w for c in counts for w in c)
    out = []
    for (i, _), t, c in zip(docs, found, counts):
        m = 100 - 25 + (25 * len(t) * n) // max(1, total)
        score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1))) * (10**9 * c[w] // (1000 * c[w] + 12 * m)) for w in terms(query) if c[w])
        if score > 0:
            out.append((-score, i is None, i or 0))
    return [(rank, None if null else i, -s) for rank, (s, null, i) in enumerate(sorted(out)[:k], 1)]


def test_search_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(search_module, "SEGMENT_BYTES", 3000)
    monkeypatch.setattr(search_module, "SEGMENT_DOCS", 70)
    docs, queries = corpus(3, 500)
    items = [(i, q) for i, q in enumerate(queries)] + [(100, None), (101, ""), (102, "nowhere"), (0, queries[0])]
    d = clash(spark.createDataFrame(docs, "doc_id long, text string").repartition(5), "term", "query", "score", "data")
    q = clash(spark.createDataFrame(items, "item_id long, text string"), "tf", "rank")
    index = build_index(d)
    assert index.segments.count() > 10
    got = {}
    for r in search(index, q).collect():
        got.setdefault(r["item_id"], []).append((r["rank"], r["doc_id"], r["score"]))
    assert {i: sorted(v, key=lambda x: x[0]) for i, v in got.items()} == {i: x for i, t in items if (x := ranked(docs, t))}


def test_search_in_several_batches_gives_the_same(spark, monkeypatch):
    docs, queries = corpus(5, 200)
    d = spark.createDataFrame(docs, "doc_id long, text string")
    q = spark.createDataFrame(list(enumerate(queries[:9])), "item_id long, text string")
    index = build_index(d)
    whole = sorted(map(tuple, search(index, q).collect()), key=str)
    monkeypatch.setattr(search_module, "BATCH_TERMS", 12)
    assert sorted(map(tuple, search(index, q).collect()), key=str) == whole


def test_search_rejects_blocks_unread():
    rng = np.random.default_rng(0)
    n = 20_000
    rare = set(rng.choice(n, 60, replace=False).tolist())
    texts = ["the " * int(rng.integers(1, 4)) + ("gold " if i in rare else "") + f"u{i}" for i in range(n)]
    seg = Segment(encode(pa.array(range(n)), pa.array(texts), n, sum(len(t.split()) for t in texts)), n, sum(len(t.split()) for t in texts))
    place = {t: i for i, t in enumerate(segment_terms_of(texts, n))}
    lists = np.array([place["the"], place["gold"]])
    heap, weight = Heap(20), np.array([100, 6000])
    search_segment(seg, lists, weight, heap)
    first = seg.blocks_read
    search_segment(seg, lists, weight, heap)
    assert seg.blocks_read - first < 0.5 * first  # the bar is up: "the" is read only where gold is
    assert set(heap.doc.tolist()) <= rare


def segment_terms_of(texts, n):
    return segment_terms(encode(pa.array(range(n)), pa.array(texts), n, 1)).to_pylist()


@pytest.mark.parametrize("top", [1, 300, 70_000])
def test_search_blocks_round_trip(top):
    rng = random.Random(top)
    texts = [" ".join(["a"] * rng.choice([0, 1, top]) + ["b"] * (rng.random() < 0.01)) for _ in range(700)]
    row = encode(pa.array(range(700)), pa.array(texts), 1, 1)
    seg = Segment(row, 1, 1)
    for name, i in {t: i for i, t in enumerate(segment_terms(row).to_pylist())}.items():
        doc, impact, _ = seg.read(np.arange(seg.list_start[i], seg.list_end[i]))
        want = [(d, t.split().count(name)) for d, t in enumerate(texts) if name in t.split()]
        assert doc.tolist() == [d for d, _ in want]
        assert impact.tolist() == impacts(np.array([c for _, c in want]), seg.m[doc]).tolist()


def test_search_of_empty_tables(spark):
    docs, items = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert search(build_index(docs), items).count() == 0
    assert search(build_index(spark.createDataFrame([(1, "a b")], docs.schema)), items.limit(0)).count() == 0
    assert search(build_index(spark.createDataFrame([(1, None), (2, "...")], docs.schema)), items).count() == 0


# ------------------------------------------------------------------ repair
def cheapest(rows):
    """(cost, audit, repaired rows) by plain strings from the end; rows: (role, text, fault)."""
    follows = {"s": {"": "s"}, "u": {"": "u", "s": "u", "a": "u"}, "a": {"u": "a"}}

    @lru_cache(None)
    def rest(i, state, inserted):
        best = (0, "", ()) if i == len(rows) and state in ("", "a") else (10**9, "", ())
        role, to = ("assistant", "a") if state == "u" else ("user", "u")
        ways = [(3, "I", i, to, inserted + 1, (role + ":",))] if inserted < 3 else []
        if i < len(rows):
            r, t, fault = rows[i]
            ways.append((4, "D", i + 1, state, 0, ()))
            if fault not in (1, 2):
                extra = 3 * (fault == 3)
                keep = follows.get(r[:1], {}).get(state)
                if keep:
                    ways.append((extra, "K", i + 1, keep, 0, (f"{r}:{t}",)))
                ways.append((3 + extra, "R", i + 1, to, 0, (f"{role}:{t}",)))
        for cost, letter, j, s, k, out in ways:
            c, a, o = rest(j, s, k)
            best = min(best, (cost + c, letter + a, out + o))
        return best

    return rest(0, "", 0)


@pytest.mark.parametrize("modulus, clean", [((1 << 61) - 1, 2048), (7, 2048), ((1 << 61) - 1, 1), (7, 1), (7, 15)])
def test_repair_equals_brute_force(monkeypatch, modulus, clean):
    monkeypatch.setattr(repair_module, "_MOD", modulus)  # 7: hashes collide all the time
    monkeypatch.setattr(repair_module, "CLEAN_AFTER", clean)
    rng = random.Random(modulus + clean)
    for _ in range(250):
        rows = [(rng.choice(["user", "assistant", "system", "tool", ""]), f"t{j}", rng.choice([0, 0, 0, 1, 2, 3])) for j in range(rng.randrange(0, 12))]
        work = Conversation()
        for j, r in enumerate(rows):
            work.row(j, *r)
        cost, audit, out = cheapest(tuple(rows))
        got = work.result()
        assert (got["cost"], got["audit"], got["repaired_sha256"]) == (cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest())


def test_audit_strings_compare_as_strings(monkeypatch):
    for modulus in ((1 << 61) - 1, 5):
        monkeypatch.setattr(repair_module, "_MOD", modulus)
        rng, tree, nodes = random.Random(modulus), Audits(), [0]
        for _ in range(300):
            nodes.append(tree.add(rng.choice(nodes[-40:]), rng.choice("DIKR")))
        for _ in range(2000):
            a, b = rng.choice(nodes), rng.choice(nodes)
            assert tree.less(a, b) == (tree.text(a) < tree.text(b))


def test_long_conversations_settle_their_audit():
    work = Conversation()
    for j in range(20_000):
        work.row(j, "user" if j % 2 == 0 else "assistant", f"t{j}.", 0 if j % 50 else 1)
    assert len(work.tree.letter) < 3 * repair_module.CLEAN_AFTER and len(work.tree.settled) > 15_000
    assert len(work.result()["audit"].replace("I", "")) == 20_000


TALK = [
    (1, 0, "system", "Be kind."), (1, 1, "user", "Hi?"), (1, 2, "user", "Hi?"), (1, 5, "assistant", "Hello"), (1, None, "user", " \t"),
    (2, 0, "assistant", "Late."), (2, 0, "assistant", "Late."), (3, None, None, None), (3, None, "user", None),
    (None, 4, "user", "a!"), (None, 4, "assistant", "b!"), (4, 1, "usher", "ok."), (4, 2, "a", "ok." + " " * 10_000), (4, 3, "", "x" * 100_000),
]


def test_repair_of_odd_rows(spark):
    rows = clash(spark.createDataFrame(TALK, "conv_id long, turn long, role string, text string").repartition(4), "fault", "dropped", "audit", "nth")
    found = audits(rows)
    got = {r["conv_id"]: r for r in found.collect()}
    want = {}
    for conv in {t[0] for t in TALK}:
        own = sorted([(t[1] is not None, t[1] or 0, " " if t[2] is None else t[2], " " if t[3] is None else t[3]) for t in TALK if t[0] == conv])
        seen, faulty, last = set(), [], lambda t: t.rstrip(" \t\n\x0b\f\r")[-1:]
        for _, _, role, text in own:
            fault = 1 if not last(text) else 2 if (role, text) in seen else 0 if last(text) in ".!?" else 3
            seen.add((role, text))
            faulty.append((role, text, fault))
        want[conv] = (faulty, cheapest(tuple(faulty)))
    assert set(got) == set(want)
    for conv, (faulty, (cost, audit, out)) in want.items():
        r = got[conv]
        assert (r["cost"], r["audit"], r["repaired_sha256"]) == (cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest())
        assert [r["blank"], r["duplicate"], r["truncated"]] == [sum(f[2] == k for f in faulty) for k in (1, 2, 3)]
        assert r["illegal"] == sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(faulty, faulty[1:]))
    assert got[1]["gaps"] == 2 and got[3]["gaps"] == 0 and got[2]["gaps"] == 0
    whole = repaired(rows, found).orderBy("position").collect()
    for conv in want:
        text = "\n".join(f"{r['role']}:{r['text']}" for r in whole if r["conv_id"] == conv)
        assert hashlib.sha256(text.encode()).hexdigest() == got[conv]["repaired_sha256"]


def test_repair_without_rows(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert audits(empty).count() == 0 and damage(empty).count() == 0
    gone = audits(spark.createDataFrame(TALK, empty.schema), F.lit(True)).collect()
    assert len(gone) == 5
    for r in gone:
        assert r["audit"] == "" and r["repaired_sha256"] == hashlib.sha256(b"").hexdigest()
        assert [r[c] for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")] == [0] * 6


# ---------------------------------------------------------------- toxicity
def labelled(spark, n=400, flip=None):
    rng = random.Random(8)
    insults, words = ["idïot", "scumbag", "moronic", "trashy"], [f"wörd{i}" for i in range(80)]
    rows, labels = [], []
    for i in range(n):
        toxic = i % 4 == 0
        text = [rng.choice(words) for _ in range(rng.randrange(20, 60))]
        for _ in range(rng.randrange(2, 6) if toxic else 0):
            text.insert(rng.randrange(len(text)), rng.choice(insults) + rng.choice(["", "s", "ly"]))
        rows.append((i, " ".join(text)))
        labels.append((i, int(toxic), 0))
    order = random.Random(flip).sample(range(n), n) if flip else range(n)
    d = spark.createDataFrame([rows[i] for i in order], "doc_id long, text string")
    return d, spark.createDataFrame([labels[i] for i in order], "doc_id long, toxic int, quality int")


def test_nearest_examples_equal_brute_force():
    rng = np.random.default_rng(1)
    n_terms, vectors = 40, []
    for _ in range(500):
        t = np.sort(rng.choice(n_terms, rng.integers(0, 9), replace=False))
        w = np.append(rng.integers(1, 4, len(t)).astype(float), 2.0)
        vectors.append((np.append(t, n_terms), w / np.sqrt((w * w).sum())))
    index = ExampleIndex(vectors, n_terms + 1)
    for i in range(200):
        t, w = vectors[i]
        cosine = np.zeros(500)
        for term, weight in zip(t, w):
            for e, (et, ew) in enumerate(vectors):
                hit = np.flatnonzero(et == term)
                if len(hit):
                    cosine[e] += weight * ew[hit[0]]
        for but in (-1, i):
            others = np.array([e for e in range(500) if e != but])
            best = others[np.lexsort((others, -cosine[others]))[:15]]
            near, got = index.nearest(t, w, 15, but)
            assert near.tolist() == best.tolist() and np.array_equal(got, cosine[best])


def test_terms_are_words_and_stems():
    texts = ["Ab côté-abcdef", "", "côtéx côté"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.cumsum([0] + [len(t.encode()) for t in texts])
    _, row, start, end = term_hashes(data, offsets)
    found = sorted((int(r), data[a:b].tobytes().decode()) for r, a, b in zip(row, start, end))
    assert found == sorted([(0, "Ab"), (0, "côté"), (0, "abcdef"), (0, "abcd"), (0, "abcde"), (2, "côtéx"), (2, "côté"), (2, "côté")])


def test_toxicity_finds_the_held_out(spark):
    d, labels = labelled(spark)
    extra = spark.createDataFrame([(900, None), (901, ""), (None, "wörd1"), (902, "x" * 200_000), (903, "You idïots, moronically trashy scumbag!"), (904, "wörd1 wörd2")], d.schema)
    rows = clash(d.unionByName(extra), "toxic", "score", "y", "h", "near")
    found = {r["doc_id"]: r for r in toxicity(rows, clash(labels, "text", "id"), F.col("doc_id") % 3 != 1).collect()}
    held = [r for i, r in found.items() if i is not None and i < 900 and i % 3 == 1]
    assert all((r["score"] >= 0.7) == (r["doc_id"] % 4 == 0) for r in held) and len(held) == 133
    assert found[903]["score"] >= 0.7 and "scumbag" in found[903]["evidence"] and all(found[903]["toxic"])
    assert found[900]["score"] == found[901]["score"] == found[902]["score"] == found[904]["score"] < 0.2
    assert None in found and all(0 <= r["score"] <= 1 for r in found.values())


def test_toxicity_model_depends_on_neither_order_nor_copies(spark):
    d, labels = labelled(spark)
    again, labels2 = labelled(spark, flip=4)
    copies = again.unionByName(again.where("doc_id = 8")).unionByName(again.where("doc_id = 9"))
    a = train(d, labels, F.lit(True))
    b = train(copies, labels2.unionByName(labels2.where("doc_id < 5")), F.lit(True))
    assert a.ids.tolist() == b.ids.tolist() and a.labels.tolist() == b.labels.tolist()
    assert a.vocabulary.hashes.tolist() == b.vocabulary.hashes.tolist()


def test_toxicity_sample_is_bounded_by_label(spark, monkeypatch):
    monkeypatch.setattr(toxicity_module, "EXAMPLES", 40)
    model = train(*labelled(spark), F.lit(True))
    assert sorted(np.unique(model.labels, return_counts=True)[1].tolist()) == [40, 40]


def test_toxicity_with_little_to_learn_from(spark):
    d, labels = labelled(spark, 20)
    assert train(d, labels, F.lit(False)) is None
    assert {r[0] for r in d.select(scored(None, F.col("text")).score).collect()} == {0.5}
    assert toxicity(d.limit(0), labels, F.lit(True)).count() == 0
    one = toxicity(d, labels.where("toxic = 0"), F.lit(True)).collect()
    assert {r["score"] for r in one} == {0.0}
    nulls = toxicity(d, labels.withColumn("toxic", F.lit(None).cast("int")), F.lit(True)).collect()
    assert {r["score"] for r in nulls} == {0.5}


def test_curve_is_calibrated():
    rng = np.random.default_rng(2)
    votes = rng.uniform(0.02, 0.98, 4000)
    labels = (rng.uniform(size=4000) < votes).astype(float)
    a, b = fit_curve(votes, labels, np.ones(4000))
    assert abs(a - 1) < 0.1 and abs(b) < 0.1
