"""Each operator on small tables: nulls, empty and odd texts, ties, repeated
rows, empty tables, clashing column names; and against brute force."""
import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tabclass.llm import fingerprints as fingerprints_module
from tabclass.llm import html_text, pii
from tabclass.llm import language_id as language_id_module
from tabclass.llm.decontaminate import leaks
from tabclass.llm.fingerprints import fingerprints, near_classes, near_pairs
from tabclass.llm.jaccard_join import jaccard_components
from tabclass.llm.language_id import language_id
from tabclass.llm.line_dedup import line_dedup
from tabclass.llm.mix import fill, mix
from tabclass.llm.quality import features, hash_bar, scored
from tabclass.llm.quality import train as train_quality
from tabclass.llm.secret_scan import discoveries, secret_scan
from tabclass.llm.shingles import text_chunks, text_shingles

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega".split()


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + str(rng.randrange(40)) for _ in range(n))


#: Odd rows: null and empty text, null id, repeated rows, blanks, a long word, columns that clash.
ODD = [(900, None), (901, ""), (902, " \t\n"), (None, prose(7, 60)), (903, prose(8, 60)), (903, prose(8, 60)), (904, "x" * 200_000), (905, "é ñ 𝒳 words")]


def docs(spark, rows):
    df = spark.createDataFrame([(i, t, "en", "s0", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    for c in ("key", "spans", "cls", "v", "size", "_gone", "h"):
        df = df.withColumn(c, F.lit("clash"))
    return df


def shingles(text, k=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def test_jaccard_components_equal_brute_force(spark):
    rng = random.Random(1)
    rows = [(i, prose(i, rng.randrange(3, 80))) for i in range(60)]
    for i in range(60, 160):  # near and exact copies, some on the edge of the threshold
        w = rows[rng.randrange(60)][1].split(" ")
        for _ in range(rng.randrange(0, 4)):
            w[rng.randrange(len(w))] = "edit" + str(rng.randrange(99))
        rows.append((i, " ".join(w)))
    rows += [r for r in ODD if r[0] is not None]
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(range(len(rows)), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 75 * len(sets[a] | sets[b]):
            parent[find(a)] = find(b)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), d), d)
    want = sorted((d, len(sets[i]), least[find(i)]) for i, (d, _) in enumerate(rows))
    assert sorted(map(tuple, jaccard_components(docs(spark, rows)).collect())) == want


def test_line_dedup_equals_definition(spark):
    rng = random.Random(2)
    pool = [prose(i, rng.randrange(0, 30)) for i in range(25)]
    rows = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randrange(1, 9)))) for i in range(40)] + [r for r in ODD if r[0] not in (None, 903)]
    seen, want = {}, {}
    for d, t in sorted((r for r in rows if r[1] is not None), key=lambda r: r[0]):
        lines = t.split("\n")
        gone = set()
        for a in range(len(lines)):
            n = 0
            for b in range(a, len(lines) if lines[a].split() else a):
                n += len(lines[b].split())
                if n >= 50:
                    body = tuple(lines[a : b + 1])
                    if seen.setdefault(body, (d, a)) != (d, a):
                        gone.update(range(a, b + 1))
                    break
        want[d] = ("\n".join(x for i, x in enumerate(lines) if i not in gone), len(lines), len(gone))
    got = {r.doc_id: (r.text, r.n_lines, r.n_removed) for r in line_dedup(docs(spark, rows)).collect()}
    assert got.pop(900) == (None, 0, 0)
    assert got == want


def test_extended_line_dedup_cuts_whole_runs(spark):
    rng = random.Random(12)
    pool = [prose(i, rng.randrange(0, 30)) for i in range(25)]
    rows = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randrange(1, 9)))) for i in range(60)]
    head, tail, other = prose(500, 60), prose(501, 40), prose(502, 10)
    rows += [(100, f"{head}\n{tail}\n{other}"), (101, f"x\n{head}\n{tail}\ny")]  # 60 and 40 shared words
    rows += [(102, f"{prose(503, 60)}\nz"), (103, f"{prose(503, 60)}\n{tail}"), (104, f"{prose(503, 60)}\n{tail}")]  # 104 shares more with 103 than with 102
    earlier, want = set(), {}
    for d, t in rows:
        lines = t.split("\n")
        runs = [(a, b) for b in range(len(lines)) for a in range(b + 1) if lines[a].split() and lines[b].split() and len(" ".join(lines[a : b + 1]).split()) >= 50]
        runs.sort()
        gone = set()
        for a, b in runs:  # by first line: an equal run that starts above is an earlier place
            body = tuple(lines[a : b + 1])
            gone |= set(range(a, b + 1)) if body in earlier else set()
            earlier.add(body)
        want[d] = ("\n".join(x for i, x in enumerate(lines) if i not in gone), len(lines), len(gone))
    assert want[101] == ("x\ny", 4, 2) and want[104] == ("", 2, 2)
    got = {r.doc_id: (r.text, r.n_lines, r.n_removed) for r in line_dedup(docs(spark, rows), extend=True).collect()}
    assert got == want


def test_leaks_exact_and_with_other_values(spark):
    question = "if Anna buys 12 apples at 3 dollars and sells them for 5 dollars how much does Anna earn in total after all"
    asked = question.replace("Anna", "Peter").replace("12", "40").replace("3 d", "7 d")
    mixed = "if Peter buys 40 apples at 7 dollars and sells them for 5 dollars how much does Maria earn in total after all"
    other = spark.createDataFrame([(1, question), (2, None), (3, "")], "item_id long, text string")
    rows = [(1, prose(1, 20) + " " + question + " " + prose(2, 9)), (2, prose(3, 30) + "\n" + asked), (3, mixed), (4, prose(4, 80)), *ODD]
    assert {(r.doc_id, r.item_id) for r in leaks(docs(spark, rows), other).collect()} == {(1, 1), (2, 1)}
    assert leaks(docs(spark, rows), other.limit(0)).count() == 0


def test_leaks_of_verbatim_passages(spark):
    twice = prose(41, 4) + " and Anna " + prose(42, 20) + " of Anna " + prose(43, 20)  # one of two equal names edited
    short, numbers, word = "the five last words match", "11 22 33 44 55 66 77 88 99 10 21 32 43 54 65", "zyzzyva"
    far = prose(44, 8) + " by Karl " + prose(45, 8)  # each run is consistent, two runs
    other = spark.createDataFrame([(1, twice), (2, short), (3, numbers), (4, word), (5, far)], "item_id long, text string")
    rows = [(1, prose(51, 30) + " " + twice.replace("of Anna", "of Maria") + " " + prose(52, 9)), (2, prose(53, 20) + " " + short + " " + prose(54, 20)),
            (3, prose(55, 20) + " x " + numbers + " " + prose(56, 20)), (4, prose(57, 3) + " (Zyzzyva) " + prose(58, 12)), (5, "x " + far.replace("Karl", "Emil")),
            (6, prose(59, 20) + " the five last words differ"), (7, "y " + numbers.replace("88", "89")), *ODD]
    found = {(r.doc_id, r.item_id): r.n_words for r in leaks(docs(spark, rows), other).collect()}
    assert found == {(1, 1): len(twice.split()) - 1, (2, 2): 5, (3, 3): 15, (4, 4): 1, (5, 5): 18}


def test_mix_meets_targets(spark):
    rng = random.Random(3)
    rows = [(i, "w " * rng.randrange(0, 60), rng.choice(["a", "b", "c", "d", None])) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = mix(df).join(df.select("doc_id", "source"), "doc_id").toPandas()
    again = mix(df).toPandas()
    assert sorted(zip(out.doc_id, out.taken)) == sorted(zip(again.doc_id, again.taken))
    by = {("" if k is None else k): g for k, g in out.groupby("source", dropna=False)}
    total = sum(g["size"].sum() for g in by.values())
    assert abs(sum(g.target.iloc[0] for g in by.values()) - 1.5 * total) < 1e-6
    assert (out.taken <= 2 * out["size"]).all() and (out.groupby("source", dropna=False).apply(lambda g: abs(g.taken.sum() - g.target.iloc[0]), include_groups=False) < 3).all()
    assert mix(df.limit(0)).count() == 0


def test_fill_is_as_close_as_a_full_search():
    rng = np.random.default_rng(0)
    for _ in range(30):
        size, count = rng.choice(np.arange(1, 40), 5, replace=False), rng.integers(1, 4, 5)
        budget = int(rng.integers(0, (size * count).sum() + 1))
        take = fill(budget, size, count)
        assert (take <= count).all() and (take * size).sum() <= budget
        base = np.array([c * budget // (size * count).sum() for c in count])
        best = max(s for q in itertools.product(*[range(b, c + 1) for b, c in zip(base, count)]) if (s := int((np.array(q) * size).sum())) <= budget)
        assert (take * size).sum() == best


def test_language_id(spark):
    vowels = {"xa": "aeiou", "xb": "yäöüå"}
    rng = random.Random(4)
    made = [(i, " ".join("".join(rng.choice("bcd") + rng.choice(vowels[lang]) for _ in range(3)) for _ in range(12)), lang) for i in range(160) for lang in ["xa" if i % 2 else "xb"]]
    df = spark.createDataFrame([*made, (900, None, "xa"), (901, "", "xa"), (902, "12 34 !", "xa"), (903, "bä cö dü", None)], "doc_id long, text string, lang string")
    out = {r.doc_id: r for r in language_id(df, F.col("doc_id") % 4 != 0).collect()}
    assert sum(out[i].lang_pred == lang for i, _, lang in made if i % 4 == 0) >= 38
    assert all(out[i].lang_pred == "und" and out[i].rejected and out[i].score == 0 for i in (900, 901, 902))
    assert out[903].lang_pred == "xb"
    assert {r.lang_pred for r in language_id(df, F.lit(False)).collect()} == {"und"}


def test_language_sample_keeps_every_language(spark, monkeypatch):
    taken = []
    monkeypatch.setattr(language_id_module, "fit", lambda x, langs: taken.append((langs, x)) or "model")
    rows = [(f"l{k:02d}", f"{w} text {i} in language {k}") for k, w in enumerate(WORDS[:12]) for i in range(300 if k < 11 else 40)]
    copies = rows + [("l00", "one text, many copies")] * 3000
    for part in (rows, copies, copies[::-1]):
        df = spark.createDataFrame(part, "lang string, text string").coalesce(1)
        assert language_id_module.train(df, F.lit(True)) == "model"
    for langs, _ in taken:
        assert {k: langs.count(k) for k in langs} == {f"l{k:02d}": 250 if k < 11 else 40 for k in range(12)}
    assert taken[1][0] == taken[2][0] and (taken[1][1] == taken[2][1]).all()


def test_quality(spark):
    good = [(i, prose(i, 40), 1) for i in range(60)]
    bad = [(100 + i, " ".join(w.upper() + "!!" for w in prose(i, 40).split()), 0) for i in range(60)]
    df = spark.createDataFrame([*good, *bad], "doc_id long, text string, quality int")
    model = train_quality(df, df.select("doc_id", "quality"), F.col("doc_id") % 3 != 0)
    out = docs(spark, [(i, t) for i, t, _ in [*good, *bad]] + ODD).select("doc_id", scored(model, F.col("text")).alias("score")).collect()
    held = {r.doc_id: r.score for r in out if r.doc_id is not None and r.doc_id < 900 and r.doc_id % 3 == 0}
    assert all((s >= 0.7) == (i < 100) for i, s in held.items()) and all(0 <= r.score <= 1 for r in out)
    x = np.array([[1.0] * model.axes.shape[0]], dtype=np.float32)
    cosine = model.latent(x) @ model.vectors.T  # against a plain loop
    near = sorted(range(cosine.shape[1]), key=lambda j: -cosine[0, j])[:15]
    weight = [max(float(cosine[0, j]), 0) ** 8 for j in near]
    want = sum(w * model.labels[j] for w, j in zip(weight, near)) / sum(weight)
    assert model.score(x)[0] == pytest.approx(want, abs=1e-4)
    assert features(np.zeros(0, np.uint8), np.array([0, 0])).sum() == 0


SECRET_TEXTS = [
    'say password: "hunter22" now', "TOKEN=abc and api-key = 'abcdef'", "AKIA" + "A1B2" * 4, "AKIASHORT", "deadbeef" * 4, "é𝒳 secret = " + "a1" * 9,
    "secret=token:abcdefgh", "token=token=abcdefgh", "0123456789abcdef0123", "",
]


def test_secret_base_spans_equal_plain_regex(spark):
    kinds = [("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), ("access", "AKIA[A-Z0-9]+"), ("hex", "[0-9a-f]+")]
    rows = list(enumerate(SECRET_TEXTS * 2)) + ODD
    want = []
    for d, t in rows:
        spans = []
        for k, (kind, p) in enumerate(kinds):
            for m in re.finditer(p, t or "", re.I if k == 0 else 0):
                if (len(m.group(2)) >= 6) if k == 0 else (m.end() - m.start() >= (20, 24)[k - 1]):
                    spans.append((m.start(), k, m.end()))
        text = ",".join(f"{kinds[k][0]}:{a}:{b}" for a, k, b in sorted(spans))
        want.append((d or -1, *[sum(s[1] == k for s in spans) for k in range(3)], hashlib.sha256(text.encode()).hexdigest()))
    got = [(r.doc_id or -1, r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in secret_scan(docs(spark, rows)).collect()]
    assert sorted(got) == sorted(want)


def test_random_keys_are_found_and_structure_is_not(spark):
    rng = random.Random(5)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    keys = ["".join(rng.choice(letters) for _ in range(n)) for n in (24, 32, 40, 40, 64)]
    rows = [(i, f"été {k} end") for i, k in enumerate(keys)]
    rows += [(100 + i, w) for i, w in enumerate(["internationalizationofthings", "aaaaaaaaaaaaaaaaaaaaaaaaaaaa", "abcdefghijklmnopqrstuvwxyz0123456789", "1" * 30] * 5)]
    out = {r.doc_id: r.spans for r in secret_scan(docs(spark, rows)).collect()}
    assert [out[i] for i in range(5)] == [f"random:4:{4 + len(k)}" for k in keys]
    assert not any("random" in out[100 + i] for i in range(20))


def test_discoveries_are_benjamini_hochberg():
    rng = random.Random(6)
    cells = [rng.choice([0, 1, 2, 5, 9, 20, 30, 60]) for _ in range(60)]
    p = sorted(10 ** (-c / 10) for c in cells)
    k = max((i + 1 for i, v in enumerate(p) if v <= 0.01 * (i + 1) / len(p)), default=0)
    bar = discoveries({"f": {c: cells.count(c) for c in set(cells)}}, 0.01).get("f", 999)
    assert sum(c >= bar for c in cells) == k


def test_pii_known_spans_and_crf(spark):
    luhn = next(f"411111111111{i:04d}" for i in range(9999) if pii.luhn(f"411111111111{i:04d}"))
    texts = [f"é mail a.b@x.example.com or 1.2.3.4 or 1.2.3.999 card {luhn[:4]} {luhn[4:8]} {luhn[8:12]} {luhn[12:]} tel +1 (017) 555-7713 end", "x@y z@ @q.r a@b.c@d.e", "no data 2024 here 12345"]
    email, ip = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"
    card, phone = r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"
    rng = random.Random(8)
    texts += ["".join(rng.choice("1234. +-@aé()") for _ in range(300)) for _ in range(60)]
    for t in texts:
        want = [(m.start(), 0, m.end()) for m in re.finditer(email, t)]
        want += [(m.start(), 1, m.end()) for m in re.finditer(ip, t) if all(int(x) <= 255 for x in m.group().split("."))]
        digits = lambda m: re.sub("[^0-9]", "", m.group())
        want += [(m.start(), 2, m.end()) for m in re.finditer(card, t) if 12 <= len(digits(m)) <= 19 and pii.luhn(digits(m))]
        want += [(m.start(), 3, m.end()) for m in re.finditer(phone, t) if 9 <= len(digits(m)) <= 15]
        assert pii.known_spans(t) == sorted(want)
    rows = [(1, "please call (499) 555-6503 today"), (2, prose(3, 50)), *ODD]
    out = {r.doc_id: r for r in pii.find_pii(docs(spark, rows)).collect()}
    assert [(s.start, s.kind, s.end) for s in out[1].added] == [(12, 3, 26)]
    assert not out[2].added and not out[900].known and not out[901].known


def test_viterbi_equals_full_search():
    rng = np.random.default_rng(9)
    score, move = rng.normal(size=(9, 3)).astype(np.float32), rng.normal(size=(3, 3)).astype(np.float32)
    sequence = np.array([0] * 4 + [1] * 5)
    want = []
    for a, b in ((0, 4), (4, 9)):
        want += max(itertools.product(range(3), repeat=b - a), key=lambda p: sum(score[a + i, t] for i, t in enumerate(p)) + sum(move[x, y] for x, y in zip(p, p[1:])))
    assert pii.viterbi(score, sequence, move).tolist() == want


def test_html_main_text(spark):
    page = (
        "<html><head><title>T</title><script>var t='</p>';</script></head><body><nav><ul><li><a href=x>Home</a></li></ul></nav><div class='ad'>Buy now.</div>"
        "<article><h1>Title &amp; more</h1><p>First  <b>bold</b>\n words.<p>Second &copy; one.</article><div class=comments><p>Nice post.</p></div><footer>&copy; all rights</footer>"
    )
    df = spark.createDataFrame([(1, "u", page), (2, "u", None), (3, "u", ""), (4, "u", "<p>"), (None, None, page)], "page_id long, url string, html string")
    out = {r.page_id: r.text for r in html_text.extract_pages(df.withColumn("text", F.lit("clash"))).collect()}
    assert out[1] == out[None] == "Title & more\n\nFirst bold words.\n\nSecond © one."
    assert out[2] == out[3] == out[4] == ""


def test_quality_sample_of_any_size():
    for n in (1, 2700, 10**6, 3 * 10**9, 10**13):
        drawn = n * (hash_bar(n) + (1 << 63)) / (1 << 64)
        assert drawn == pytest.approx(min(n, 2700), rel=1e-3)


@pytest.mark.parametrize("page, want", [
    ("<html><head><title>T</title><meta charset=x><body><p>one<p>two</body></html>", ["one", "two"]),
    ("<head><title>T</title><link rel=x><style>s</style><p>one</p><p>two", ["one", "two"]),
    ("<head><title>T</title><a href=x>one</a> two<p>three", ["one two", "three"]),
    ("<head><title>T</title>\n one <b>two</b><p>three", ["one two", "three"]),
    ("<head><title>T</title><noscript>n</noscript></head><p>one", ["one"]),
    ("<head><html><title>T</title><body><p>one", ["one"]),
    ("<body><p>a<video><p>one</p></video></p><p>two</p><div>three</div>", ["a", "one", "two", "three"]),
    ("<ul><li>a<button>go<li>one<li>two</ul><p>three", ["a", "one", "two", "three"]),
    ("<p>a<object><p>hid</p></object></p><p>one", ["a", "one"]),
    ("<p>a <svg width='1'/> one</p><p>two", ["a", "one", "two"]),
    ("<p>a</p><svg class=x /><p>one</p><svg><text>hid</text></svg><p>two", ["a", "one", "two"]),
    ("<p>a</p><svg width=5/><text>hid</text></svg><p>one", ["a", "one"]),
    ("<p>a</p><svg><path d=x /><text>hid<p>one</p><p>two", ["a", "one", "two"]),
    ("<p>a</p><math/><p>one</p><math><mi>hid</mi><p>two", ["a", "one", "two"]),
    ("<p>a</p><math><mtext><b>hid</b></mtext></math><p>one", ["a", "one"]),
    ("<p>a</p><script/>hid</script><p>one", ["a", "one"]),
])
def test_html_text_after_errors_and_omissions(page, want):
    assert [t for _, t, _ in html_text.blocks(page)] == want


def test_fingerprints_of_edited_texts(spark):
    rows = [(3, prose(3, 50)), (1, prose(1, 30)), (2, prose(1, 30)), (5, "é𝒳 short"), (7, ""), (8, None)]
    out = {r.doc_id: r for r in fingerprints(docs(spark, [*rows, (None, "lost one")])).collect()}
    order = sorted((d, t or "") for d, t in rows)
    for i, (d, t) in enumerate(order):
        nxt, half = order[(i + 1) % len(order)][1], len(t) // 2
        assert out[d].edited_sha256 == hashlib.sha256((t[: len(t) - half] + nxt[:half]).encode()).hexdigest()
        assert out[d].n_chars == len(t)
    assert out[1].fingerprint == out[2].fingerprint and out[1].near_next == 1.0 and out[7].near_next == 1.0 and out[None].near_next == 0.0
    estimate = out[2].near_edited
    a, b = shingles(order[1][1]), shingles(order[1][1][: len(order[1][1]) - len(order[1][1]) // 2] + order[2][1][: len(order[1][1]) // 2])
    assert abs(estimate - len(a & b) / len(a | b)) < 0.25


def test_near_pairs_are_verified(spark):
    base = prose(1, 60).split()
    rows = [(1, " ".join(base)), (2, " ".join(base[:-1] + ["end"])), (3, prose(2, 60)), *ODD]
    pairs = near_pairs(docs(spark, rows)).collect()
    assert [(r.a, r.b) for r in pairs] == [(1, 2)]
    a, b = shingles(rows[0][1]), shingles(rows[1][1])
    assert pairs[0].jaccard == pytest.approx(len(a & b) / len(a | b))


def test_false_hubs_hide_no_near_pair(spark):
    rng = random.Random(5)
    parts = [prose(700 + i, 30) for i in range(20)]
    core = " ".join(parts)
    hubs = [(i, " ".join(x for j, x in enumerate(parts) if j in set(keep))) for i in range(1, 101) for keep in [rng.sample(range(20), 15)]]
    rows = [*hubs, (1000, core + " " + prose(801, 60)), (1001, core + " " + prose(802, 60)), (1002, core + " " + prose(802, 60))]
    sets = {i: shingles(t) for i, t in rows}
    pairs = {(r.a, r.b) for r in near_pairs(docs(spark, rows)).collect()}
    assert all(len(sets[a] & sets[b]) >= 0.75 * len(sets[a] | sets[b]) for a, b in pairs)
    assert (1000, 1001) in pairs
    found = {r.doc_id: r.near_class for r in near_classes(docs(spark, rows + ODD)).collect()}
    assert found[1000] == found[1001] == found[1002] and found[903] == 903 and None not in found


def test_parities_bound_the_difference_of_sets():
    rng = random.Random(3)
    base = prose(31, 300).split()
    texts = [" ".join(base)]
    for n in (0, 1, 5, 40, 200):
        w = list(base)
        for _ in range(n):
            w[rng.randrange(len(w))] = "edit" + str(rng.randrange(9999))
        texts.append(" ".join(w))
    ((_, data, offsets),) = text_chunks(pa.array([*texts, None, "two words"]))
    value, row = text_shingles(data, offsets, 5)
    odd = fingerprints_module.parities(value, row, len(offsets) - 1)
    bits = np.unpackbits(odd.view(np.uint8), axis=1)
    sets = [set(value[row == i].tolist()) for i in range(len(offsets) - 1)]
    for i, j in itertools.combinations(range(len(sets)), 2):
        assert (bits[i] != bits[j]).sum() <= len(sets[i] ^ sets[j])
    assert (bits[0] != bits[1]).sum() == 0 and (bits[0] != bits[5]).sum() > 300


def test_pairs_that_cannot_link_are_not_compared(spark, monkeypatch):
    """One class of near-copies, and texts that share much with it, but too little."""
    core = prose(500, 200).split()
    rows = [(i, " ".join(core + [f"end{i}"])) for i in range(1, 61)]
    rows += [(i, " ".join(core[:110] + prose(1000 + i, 90).split())) for i in range(100, 160)]
    sets = {i: shingles(t) for i, t in rows}
    alike = {(a, b) for a, b in itertools.combinations(sets, 2) if len(sets[a] & sets[b]) >= 0.75 * len(sets[a] | sets[b])}
    compared, inner = [], fingerprints_module._similar
    monkeypatch.setattr(fingerprints_module, "_similar", lambda pairs, *a: compared.append(pairs.count()) or inner(pairs, *a))
    found = {r.doc_id: r.near_class for r in near_classes(docs(spark, rows)).collect()}
    assert all(found[i] == 1 for i in range(1, 61)) and all(found[i] == i for i in range(100, 160))
    assert not any(b >= 100 for _, b in alike) and sum(compared) < 3 * 60


def test_late_links_between_parts_of_a_bucket_are_found(spark, monkeypatch):
    """Chains of near-copies of which only neighbours link, against brute force."""
    rng = random.Random(8)
    monkeypatch.setattr(fingerprints_module, "BLOCK", 4)
    rows = []
    for chain in range(3):
        w = prose(40 + chain, 120).split()
        for step in range(8):
            rows.append((rng.randrange(10**6), " ".join(w)))
            for _ in range(3):
                w[rng.randrange(len(w))] = f"c{chain}s{step}r{rng.randrange(99)}"
    sets = {i: shingles(t) for i, t in rows}
    sigs = {i: np.frombuffer(bytes.fromhex(r), np.uint32).reshape(16, 4) for i, r in fingerprints(docs(spark, rows)).select("doc_id", "fingerprint").collect()}
    least = {i: i for i in sets}
    for _ in sets:
        for a, b in itertools.combinations(sets, 2):
            if least[a] != least[b] and (sigs[a] == sigs[b]).all(axis=1).any() and len(sets[a] & sets[b]) >= 0.75 * len(sets[a] | sets[b]):
                low, high = sorted((least[a], least[b]))
                least = {k: low if v == high else v for k, v in least.items()}
    assert {r.doc_id: r.near_class for r in near_classes(docs(spark, rows)).collect()} == least


def test_fingerprints_carry_the_classes(spark):
    rows = [(i * 3, prose(i % 7, 40)) for i in range(30)] + [(3, "another text of id three"), (6, prose(6, 40)), (None, prose(2, 40)), *ODD]
    d = docs(spark, rows)
    classes = near_classes(d)
    got = fingerprints(d, classes=classes)
    joined = fingerprints(d).join(classes, "doc_id", "left").withColumn("near_class", F.coalesce("near_class", "doc_id"))
    key = lambda r: tuple(str(r[c]) for c in sorted(joined.columns))
    assert got.count() == len(rows) and sorted(map(key, got.collect())) == sorted(map(key, joined.collect()))
    assert {r.near_class for r in got.where("doc_id = 87").collect()} == {3}  # the text of 3, 24, 45, 66 and 87


def test_empty_tables(spark):
    none = docs(spark, [])
    assert [f(none).count() for f in (jaccard_components, line_dedup, mix, secret_scan, pii.find_pii, fingerprints)] == [0] * 6


def test_pipeline_stages_keep_clean_documents(spark, tmp_dir):
    import corpus_pipeline

    rows = [(i, prose(i, 60), "en", "s%d" % (i % 3), 1) for i in range(60)]
    rows += [(100, rows[4][1], "en", "s0", 1), (101, prose(900, 30) + " " + prose(77, 20), "en", "s1", 1), (102, None, "en", "s1", 1)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_dir}/documents.parquet")
    spark.createDataFrame([(1, prose(77, 20))], "item_id long, text string").write.parquet(f"{tmp_dir}/benchmark.parquet")
    got = {r.doc_id for r in corpus_pipeline.run(spark, tmp_dir).collect()}
    assert got == set(range(60))
    assert zlib.crc32(b"1") % 5 == spark.range(1, 2).select(F.crc32(F.col("id").cast("string").cast("binary")) % 5).first()[0]


def test_pii_of_very_long_number_parts():
    text = "1.2.3." + "0" * 5000 + "1 and 1.2.3." + "9" * 5000
    known, _ = pii.scan(pa.array([text]), *pii.trained())
    assert known == [[(0, 1, 5007)]]


def test_pii_cost_is_linear_in_the_spans_of_a_text():
    emit, move = pii.trained()
    one = "Mail é to ann@example.org or call (555) 010-9999 now, jo (at) example (dot) org.\n"
    small, large = (pii.scan(pa.array([one * n]), emit, move) for n in (3, 8000))
    period = len(one)
    for few, many in zip(small, large):
        assert many[0] == [(a + period * k, kind, b + period * k) for k in range(8000) for a, kind, b in few[0] if b <= period]


def test_quality_sample_ignores_order_and_copies(spark):
    rows = [(i, prose(i, 30 + i % 7)) for i in range(60)]
    labels = [(i, i % 2) for i in range(60)] + [(3, 0), (3, 1), (4, 1), (4, 1)]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    many = spark.createDataFrame(rows[::-1] + [rows[7]] * 500, d.schema)
    a = train_quality(d, spark.createDataFrame(labels, "doc_id long, quality int"), F.lit(True))
    b = train_quality(many, spark.createDataFrame(labels[::-1], "doc_id long, quality int"), F.lit(True))
    assert a.labels.tolist() == b.labels.tolist() and a.prior == b.prior and len(a.labels) == 60
    assert a.labels[3] == 1.0 and a.labels[4] == 1.0 and a.labels[6] == 0.0
    assert np.allclose(a.vectors, b.vectors)


def test_blocks_and_doubtful_stretches_decode_as_whole_lines():
    rng = np.random.default_rng(4)
    for trial in range(40):
        n = int(rng.integers(1, 1200))
        score, move = rng.normal(size=(n, 6)).astype(np.float32), rng.normal(size=(6, 6)).astype(np.float32)
        score[:, 0] += rng.choice([0, 3, 9])
        sequence = np.cumsum(rng.random(n) < rng.choice([0.0, 0.004, 0.05]))
        whole = pii.viterbi(score, sequence, move)
        assert (pii._in_blocks(score, sequence, move) == whole).all()
        assert (pii.decode(score, sequence, move) == whole).all()
        assert not whole[pii.surely_plain(score, move)].any()


def test_run_probabilities_equal_full_sums():
    rng = np.random.default_rng(5)
    score, move = rng.normal(size=(7, 3)).astype(np.float32), rng.normal(size=(3, 3)).astype(np.float32)
    sequence = np.array([0, 0, 0, 0, 1, 1, 1])
    low, high = np.array([1, 4, 0]), np.array([3, 5, 4])
    for a, b, got in zip(low, high, pii.run_probabilities(score, sequence, move, low, high, 2)):
        first, last = (0, 4) if a < 4 else (4, 7)
        ways = {p: np.exp(sum(score[first + i, t] for i, t in enumerate(p)) + sum(move[x, y] for x, y in zip(p, p[1:]))) for p in itertools.product(range(3), repeat=last - first)}
        want = sum(w for p, w in ways.items() if all(t == 2 for t in p[a - first : b - first])) / sum(ways.values())
        assert got == pytest.approx(want, rel=1e-4)


def test_crf_finds_planted_local_numbers():
    """Precision and recall on sentences of invented words that training has not seen."""
    rng = random.Random(6)
    digit = lambda k: "".join(rng.choice("0123456789") for _ in range(k))
    groups = [lambda: f"0{digit(2)} {digit(4)} {digit(4)}", lambda: f"0{digit(2)} {digit(6)}", lambda: f"{digit(3)}-{digit(4)}", lambda: f"({digit(3)}) {digit(3)}-{digit(4)}", lambda: f"0{digit(4)} {digit(3)} {digit(3)}"]
    others = [lambda: f"19{digit(2)}-20{digit(2)}", lambda: f"20{digit(2)}-0{1}-1{digit(1)}", lambda: f"{digit(4)}", lambda: f"978-3-{digit(2)}-{digit(6)}-{digit(1)}"]
    texts, want = [], []
    for i in range(400):
        value = rng.choice(groups)() if i % 2 else rng.choice(others)()
        lead = f"{prose(i, 6)} {rng.choice(['tel', 'call', 'fax', 'phone:']) if i % 2 else rng.choice(['in', 'isbn', 'since'])} "
        texts.append(f"{lead}{value} {prose(i + 1000, 5)}")
        want.append([(len(lead), 3, len(lead) + len(value))] if i % 2 else [])
    _, added = pii.scan(pa.array(texts), *pii.trained())
    right = sum(a == w for a, w in zip(added, want) if w)
    assert right >= 180 and right >= 0.95 * sum(map(len, added))
    print("planted local numbers: precision", right / sum(map(len, added)), "recall", right / 200)


def test_tags_near_a_cut_are_those_of_the_whole_line():
    one = "call (499) 555-6503 today "
    for n in (100, 125, 126, 127, 128, 129, 300):
        line = "word " * n + one + "word " * n
        _, added = pii.scan(pa.array([line]), *pii.trained())
        assert added == [[(5 * n + 5, 3, 5 * n + 19)]]
