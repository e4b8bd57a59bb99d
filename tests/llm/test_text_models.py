"""Language identification, quality rules, url filter, license scans."""

import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpus_mt.llm import langid, license_scan, quality, url_filter
from corpus_mt.llm.license_scan import Notice

FOLDER = "/root/testdata/sf0.001"
ENGLISH = ["the house and the garden of the king", "this is that which they have with them", "when would the others come here"]
GERMAN = ["das haus und der garten des königs", "dies ist das was sie mit ihnen haben", "wann würden die anderen hierher kommen"]


def labelled(spark):
    rows = [(i, t, "en") for i, t in enumerate(ENGLISH * 4)] + [(100 + i, t, "de") for i, t in enumerate(GERMAN * 4)] + [(999, "quux", None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_languages_and_edge_texts(spark):
    model = langid.fit(labelled(spark))
    assert model.languages == ["de", "en"]
    texts = ["the garden", "der garten", None, "", "123 !?", "THE KING AND THE HOUSE", "the\0garden\0of", "das haus " * 50_000]
    rows = [(i, t, "zz", 7.0) for i, t in enumerate(texts)] + [(None, "the king", "zz", 7.0)] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string, lang_pred string, score double")
    got = {(r.doc_id, r.text): (r.lang_pred, r.score) for r in langid.predict(df, model).collect()}
    assert [got[i, t][0] for i, t in enumerate(texts)] == ["en", "de", "und", "und", "und", "en", "en", "de"]
    assert got[None, "the king"][0] == "en" and all(0 <= s <= 1 for _, s in got.values()) and got[2, None][1] == 0.0
    assert langid.predict(df.limit(0), model).count() == 0


def test_scores_like_brute_force(spark):
    model = langid.fit(labelled(spark))
    folded, offsets = langid._fold(pa.array(["Ab, c", None, "ä"]))
    assert "".join(map(chr, folded)) == " ab c  ä" and offsets.tolist() == [0, 5, 6, 8]
    names, scores = langid.score_texts(pa.array(ENGLISH + GERMAN), *model)
    for text, name, score in zip(ENGLISH + GERMAN, names, scores, strict=True):
        padded = " " + text
        total = np.zeros(2)
        for n in langid.ORDERS:
            buckets = langid._buckets(np.array([ord(c) for c in padded], np.uint32), n)
            for end in range(n - 1, len(padded)):
                if n > 1 or padded[end] != " ":
                    total += model.matrix[buckets[end]]
        assert name == model.languages[total.argmax()] and score == pytest.approx(1 / np.exp(total - total.max()).sum())


def test_unlabelled_tables(spark):
    model = langid.fit(labelled(spark).withColumn("lang", F.lit(None).cast("string")))
    assert [r.lang_pred for r in langid.predict(labelled(spark), model).collect()] == ["und"] * 25
    assert langid.fit(labelled(spark).limit(0)).languages == []


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.fit(docs.filter(~langid.held_out()))
    judged = langid.predict(docs.filter(langid.held_out() & F.col("lang").isNotNull()), model)
    assert judged.select(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.97


def test_sample_is_bounded_and_even(spark):
    rows = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("abc").alias("text"), F.when(F.col("id") < 2700, "a").otherwise("b").alias("lang"))
    model = langid.fit(rows, sample_rows=400)
    assert model.languages == ["a", "b"]


# --- quality ---------------------------------------------------------------------------


def plain_base(text):
    text = text or ""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {j for i, w in enumerate(windows) if windows.count(w) > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def test_base_rules_like_brute_force(spark):
    rng = random.Random(2)
    texts = [None, "", " \n\t", "a", "a b", "a b c a b c", "x\n x\nx\n\nx", "é🙂 \u00a0x #*$%&|<>", "a a a a", "\x0b\x0ca\x1cb"]
    texts += [" ".join(rng.choice("abc") for _ in range(rng.randint(1, 40))) for _ in range(60)]
    texts += ["\n".join(rng.choice(["a b", "c", "", " ", "a b "]) for _ in range(12)) for _ in range(20)]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, n_words string")
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1)], "doc_id long, quality int")
    rows = sorted(quality.judge(df, labels).collect(), key=lambda r: r.doc_id)
    assert [(r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in rows] == [plain_base(t) for t in texts]
    assert all(r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) and not (r.base_failed and r.kept) for r in rows)


def test_ratio_like_brute_force(spark, monkeypatch):
    monkeypatch.setattr(quality, "BUCKETS", 64)
    texts = ["a b c d", "a b x y", "q q q", "", None, "a b c d"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(0, 1), (2, 0)], "doc_id long, quality int")
    grams = []
    for t in texts:
        words = (t or "").split()
        pairs = [*((w,) for w in words), *zip(words, words[1:])]
        hashed = spark.createDataFrame([(i, *p, None)[:3] for i, p in enumerate(pairs)] or [(0, None, None)], "i int, a string, b string")
        bucket = F.pmod(F.when(F.col("b").isNull(), F.xxhash64("a")).otherwise(F.xxhash64("a", "b")), F.lit(64))
        grams.append([r[0] for r in hashed.filter("a is not null").select(bucket).collect()])
    raw, good = np.zeros(64), np.zeros(64)
    for i, g in enumerate(grams):
        np.add.at(raw, g, 1)
        if i == 0:
            np.add.at(good, g, 1)
    prior = quality.PRIOR * 64
    with np.errstate(divide="ignore", invalid="ignore"):
        ratio = np.where(raw > 0, np.log((good * raw.sum() / raw + prior) / (good.sum() + prior)), 0.0)
    rows = sorted(quality.judge(df, labels).collect(), key=lambda r: r.doc_id)
    assert [r.score for r in rows] == pytest.approx([float(ratio[g].mean()) if g else 0.0 for g in grams])


def test_quality_without_labels_or_rows(spark):
    df = spark.createDataFrame([(1, "a " * 60 + " ".join(f"w{i}" for i in range(90)))], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    row = quality.judge(df, labels).first()
    assert (row.score, row.kept) == (0.0, True)
    assert quality.judge(df.limit(0), labels).count() == 0 and quality.keep(df, labels).columns == ["doc_id", "text"]


def test_clean_documents_stay(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    judged = quality.judge(docs, labels).join(labels, "doc_id").filter("not base_failed")
    assert judged.filter("quality = 1 and not kept").count() == 0


@pytest.mark.parametrize("folder", ["sf0.01"])
def test_bad_documents_go_on_a_small_table(spark, folder):
    docs, labels = (spark.read.parquet(f"/root/testdata/{folder}/{t}.parquet") for t in ("documents", "labels"))
    judged = quality.judge(docs, labels).join(labels, "doc_id", "left").select("quality", "base_failed", "kept").collect()
    bad = [r.kept for r in judged if r.quality == 0]
    rest = [r.kept for r in judged if r.quality is None and not r.base_failed]
    print("kept", sum(bad), "of", len(bad), "bad,", sum(rest), "of", len(rest), "unlabelled")
    assert sum(bad) < 0.35 * len(bad) and sum(rest) > 0.8 * len(rest)
    assert all(r.kept for r in judged if r.quality == 1 and not r.base_failed)


def test_bar_lies_between_the_labels():
    assert quality.bar_between([0.0, 0.1], [-0.2, -0.1]) == pytest.approx(-0.05)
    assert quality.bar_between([k / 100 for k in range(100)], [0.5] * 9) <= 0.05


def test_bar_of_a_table_is_that_of_its_lists(spark):
    rng = random.Random(5)
    for n_good, n_bad, wide in ((1, 1, 0.1), (40, 30, 0.01), (500, 300, 3.0)):
        good = [round(rng.gauss(0.2, 1) * wide, 6) for _ in range(n_good)]
        bad = [round(rng.gauss(-0.2, 1) * wide, 6) for _ in range(n_bad)] + good[:n_bad:3]
        rows = [(x, 1) for x in good] + [(x, 0) for x in bad]
        assert quality.find_bar(spark.createDataFrame(rows, "score double, _mark int")) == quality.bar_between(good, bad)
    assert quality.find_bar(spark.createDataFrame([(0.5, 1)], "score double, _mark int")) is None


def test_every_label_counts(spark, monkeypatch):
    """More good documents than a sample once held."""
    monkeypatch.setattr(quality, "BUCKETS", 64)
    n = 60_000
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.lit("a").alias("text"))
    labels = docs.filter("doc_id % 100 > 0").select("doc_id", F.lit(1).alias("quality"))
    marks = quality._marks(labels, "doc_id", "quality")
    marked = quality.labelled_texts(docs, marks)
    good = n // 100 * 99
    assert quality.trusted_keys(labels).count() == marked.count() == good
    # Keys of another type meet as well, without the bits.
    assert quality.labelled_texts(docs.withColumn("doc_id", F.col("doc_id").cast("int")), marks).count() == good
    _, farther = quality.log_ratios(docs, marked)
    prior = quality.PRIOR * 64
    near = [math.expm1(math.log1p(good / prior) / f) * prior for f in farther]  # n-grams of either half
    assert sum(near) == pytest.approx(good) and min(near) > 0.4 * good


def test_good_documents_of_both_halves_reach_the_bar(spark, monkeypatch):
    words = lambda i, c: " ".join(f"{c}{(i * 7 + k * k) % 211}" for k in range(60))
    rows = [(i, words(i, "g"), 1) for i in range(40)] + [(100 + i, words(i, "b"), 0) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    seen = []
    monkeypatch.setattr(quality, "find_bar", lambda rated: seen.extend(rated.select("_key", "_mark").collect()))
    assert quality.fit(df.drop("quality"), df)[1] == quality.BAR
    assert sorted(r["_key"] for r in seen) == sorted(r[0] for r in rows)


# --- urls --------------------------------------------------------------------------------

RULES = [url_filter.Rule("net", "/", "block"), url_filter.Rule("example.net", "/en/", "allow"), url_filter.Rule("example.com", "/de/", "block"), url_filter.Rule("org", "/fr/", "allow")]
URLS = [
    ("https://A.Example.NET/en/1?x#y", "a.example.net", "/en/1", "example.net/en/"),
    ("http://example.net/fr/1", "example.net", "/fr/1", "net/"),
    ("http://badexample.com/de/", "badexample.com", "/de/", None),
    ("x://www.example.com/de/9", "www.example.com", "/de/9", "example.com/de/"),
    ("http://b.org/fr", "b.org", "/fr", None),
    ("http://a.net?q=http://c.net/", "a.net", "", None),
    ("http://a.net#/", "a.net", "", None),
    ("no scheme", "", "", None),
    (None, "", "", None),
    ("http://ÀB.org/fr/x", "Àb.org", "/fr/x", "org/fr/"),
    ("http://\nh.net/a\nb", "\nh.net", "/a\nb", "net/"),
]


def test_url_parts_and_rules(spark):
    df = spark.createDataFrame([(i, u[0], "clash", "clash") for i, u in enumerate(URLS)], "page_id long, url string, host string, tokens string")
    words = spark.createDataFrame([("example", 5), ("bad", 5)], "word string, n long")
    rows = sorted(url_filter.filter_urls(df, RULES, words).collect(), key=lambda r: r.page_id)
    assert [(r.host, r.path, r.rule) for r in rows] == [u[1:] for u in URLS]
    assert all(r.verdict == {"net/": "block", "example.com/de/": "block"}.get(r.rule, "allow") for r in rows if r.rule)
    assert {r.verdict for r in rows} <= {"allow", "block"} and rows[8].verdict == rows[7].verdict == "allow"
    assert rows[2].host_words == ["bad", "example", "com"]
    assert url_filter.filter_urls(df.limit(0), RULES, words.limit(0)).count() == 0
    with pytest.raises(ValueError):
        url_filter.rule_of(RULES * 300)


def test_best_cut_is_the_likeliest():
    counts = {"no": 30, "where": 20, "now": 25, "here": 40, "nowhere": 1}
    name, total = "nowhere", 116
    edges = [(i, len(w), n) for w, n in counts.items() for i in range(len(name)) if name.startswith(w, i)]

    def cuts(rest):
        if not rest:
            return [[]]
        heads = [w for w in counts if rest.startswith(w)] + [rest[0]]
        return [[h, *t] for h in dict.fromkeys(heads) for t in cuts(rest[len(h) :])]

    score = lambda ws: sum(math.log(counts[w] / total) if w in counts else -math.log(total + 1) for w in ws)
    assert score(url_filter.best_cut(name, edges, total)) == pytest.approx(max(map(score, cuts(name))))
    assert url_filter.best_cut("", [], 1) == [] and url_filter.best_cut("ab", [], 1) == ["ab"]


def test_classifier_learns_from_host_words(spark):
    rows = [(i, f"http://casino{w}.com/x") for i, w in enumerate(("play", "win", "luck"))] + [(9 + i, f"http://garden{w}.com/x") for i, w in enumerate(("rose", "tree", "leaf"))]
    rows += [(20, "http://casinorose.com/x"), (21, "http://gardenwin.com/y"), (22, "http://casinocasino.com/")]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    words = spark.createDataFrame([(w, 10) for w in ("casino", "garden", "play", "win", "luck", "rose", "tree", "leaf")], "word string, n long")
    labels = spark.createDataFrame([(i, "block") for i in range(3)] + [(9 + i, "allow") for i in range(3)], "page_id long, label string")
    got = {r.page_id: r for r in url_filter.filter_urls(pages, [], words, labels=labels).collect()}
    assert got[22].verdict == "block" and got[22].host_words == ["casino", "casino", "com"] and got[20].score == pytest.approx(0.5, abs=0.2)
    assert all(got[i].verdict == "block" for i in range(3)) and all(got[9 + i].verdict == "allow" for i in range(3))


def test_one_host_with_most_pages(spark):
    pages = spark.range(3000).select(F.col("id").alias("page_id"), F.when(F.col("id") % 3 > 0, "http://hothost.net/a").otherwise(F.concat(F.lit("http://h"), "id", F.lit(".com/b"))).alias("url"))
    words = spark.createDataFrame([("hot", 3), ("host", 3)], "word string, n long")
    out = url_filter.filter_urls(pages, RULES, words)
    assert out.count() == 3000 and out.filter("host = 'hothost.net'").select("host_words").distinct().collect()[0][0] == ["hot", "host", "net"]


# --- licenses ------------------------------------------------------------------------------


def test_base_places(spark):
    texts = [None, "", "Under the MIT\nLicense, under--the mit license", "under the mit licenses", "cc-by-nc cc by nc", "Apache License, Version 2.0!", "éunder the mit license"]
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, labels int")
    rows = license_scan.license_digest(license_scan.scan_licenses(df)).orderBy("doc_id").collect()
    assert [(r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in rows] == [
        (0, 0, None, None, ""), (0, 0, None, None, ""), (8, 2, 0, 4, "mit"), (4, 0, None, None, ""), (6, 2, 0, 3, "cc-by-nc"), (5, 1, 0, 0, "apache-2"), (4, 0, None, None, ""),
    ]
    assert all(set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1 for r in rows)
    assert license_scan.scan_licenses(df.limit(0)).count() == 0


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_edited_notices_are_found_with_their_spans():
    rng, notice = random.Random(4), Notice("gpl", "gnu general public license", 3)
    scanner = license_scan.Scanner((), (notice,))
    for _ in range(300):
        text = list(notice.words)
        for _ in range(rng.randint(0, 3)):
            i = rng.randrange(len(text))
            text[i : i + rng.randint(0, 1)] = [rng.choice("abcxyz")] * rng.randint(0, 1)
        noisy = "".join(text)
        line = f" lead words {' '.join(noisy.split())} tail ".encode()
        spans = scanner.fuzzy(line)
        assert len(spans) == 1 and spans[0]["edits"] <= 3
        words = line.decode().split()
        found = " ".join(words[spans[0]["start_word"] : spans[0]["end_word"]])
        assert found == spans[0]["found"] and edits(found, notice.words) <= 3
    assert scanner.fuzzy(b" gnu general pubxxxx lixxnse ") == []


def test_seeds_miss_nothing():
    rng = random.Random(6)
    notice = Notice("n", "abc bca", 2)
    scanner = license_scan.Scanner((), (notice,))
    for _ in range(400):
        words = ["".join(rng.choice("abc") for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(0, 9))]
        line = f" {' '.join(words)} ".encode() if words else b""
        runs = {" ".join(words[i:j]) for i in range(len(words)) for j in range(i + 1, len(words) + 1)}
        assert bool(scanner.fuzzy(line)) == any(edits(r, notice.words) <= 2 for r in runs)


def test_very_long_text(spark):
    text = "word " * 200_000 + "GNU General Publik License" + " word" * 200_000
    row = license_scan.license_digest(license_scan.scan_licenses(spark.createDataFrame([(1, text)], "doc_id long, text string"))).first()
    assert (row.n_words, row.labels, row.base_labels) == (400_004, "gpl", "") and row.score == pytest.approx(1 - 1 / 26)


def test_more_than_a_thousand_languages(spark):
    rows = [(i, f"w{chr(0x4E00 + i)} {chr(0x4E00 + i)}{chr(0x5E00 + i)}", f"l{i:04}") for i in range(1001)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(df)
    assert len(model.languages) == 1001 and model.matrix.shape == ((1 << 14) + 1, 1001)
    got = langid.predict(df.filter("doc_id % 50 = 0"), model).collect()
    assert sum(r.lang_pred == r.lang for r in got) >= 0.9 * len(got)
    assert langid.bucket_bits(1000) == langid.BUCKET_BITS and langid.bucket_bits(10**6) == langid.LEAST_BITS


def test_long_names_are_cut(spark):
    words = spark.createDataFrame([("good", 50), ("casino", 40), ("news", 30)], "word string, n long")
    hosts = ["goodcasino" * 8 + ".com", "goodcasino" * 20, "x" * 5000 + "casino", "goodnews.goodcasino", ""]
    got = {r.host: r.host_words for r in url_filter.host_tokens(spark.createDataFrame([(h,) for h in hosts], "host string"), words).collect()}
    assert got[hosts[0]][:16] == ["good", "casino"] * 8 and got[hosts[1]] == ["good", "casino"] * 20
    assert got[hosts[2]][-1] == "casino" and "".join(got[hosts[2]]) == hosts[2]
    assert got[hosts[3]] == ["good", "news", "good", "casino"]


def test_url_verdicts_like_brute_force(spark):
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet")
    rules = [url_filter.Rule("net", "/", url_filter.BLOCK), url_filter.Rule("org", "/", url_filter.ALLOW)]
    got = url_filter.filter_urls(pages, rules, url_filter.count_words(pages, "html")).collect()
    tokens = lambda r: [("h", w) for w in r.host_words or []] + [("p", w) for w in re.sub(r"[^\w]+|_", " ", re.sub(r"\d+", " 0 ", r.path.lower())).split()]
    counts = {v: {} for v in (url_filter.BLOCK, url_filter.ALLOW)}
    for r in got:
        if r.rule:
            for t in tokens(r):
                counts[r.verdict][t] = counts[r.verdict].get(t, 0) + 1
    logs = {v: math.log(sum(c.values()) + url_filter.BUCKETS) for v, c in counts.items()}
    assert any(r.rule for r in got) and any(not r.rule for r in got)
    for r in got:
        odds = sum(math.log(counts["block"].get(t, 0) + 1) - logs["block"] - math.log(counts["allow"].get(t, 0) + 1) + logs["allow"] for t in tokens(r))
        assert r.score == pytest.approx(1 / (1 + math.exp(-odds)), abs=1e-9)
        assert r.rule or r.verdict == ("block" if odds > 1e-9 else "allow")


def test_overlapping_and_repeated_notices():
    scanner = license_scan.Scanner((), (Notice("gpl", "gnu general public license", 3),))
    line = lambda text: b" " + text.encode() + b" "
    bad, good = "gnu genxral publxc license", "gnu general public license"
    for text in (f"{bad} {good}", f"{good} {bad}"):
        got = scanner.fuzzy(line(text))
        assert [(x["start_word"], x["end_word"], x["edits"]) for x in got] == [(0, 4, 2 * text.startswith(bad)), (4, 8, 2 * text.endswith(bad))]
    got = scanner.fuzzy(line(" ".join([good, bad] * 2_000)))
    assert [x["start_word"] for x in got] == list(range(0, 16_000, 4))
    # A match may not end within a word.
    assert scanner.fuzzy(line("gnu general public licensexxxxxxxx")) == []


def test_very_many_places_take_no_square_time():
    import time

    scanner = license_scan.Scanner(license_scan.PHRASES, ())
    line = b" " + b"cc by nc " * 100_000
    began = time.process_time()
    got = scanner.base(line)
    assert time.process_time() - began < 1.0
    assert len(got) == 100_000 and got[-1] == ("cc-by-nc", 299_997, 300_000)


# --- the pipeline's quality stage ----------------------------------------------------------


def test_pipeline_quality_stage_takes_every_label(spark, tmp_path, monkeypatch):
    import corpus_pipeline

    number = F.col("id").cast("string")
    words = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(60)), lambda k: F.concat(F.lit("w"), F.pmod(F.col("id") * 7 + k * k, F.lit(997)).cast("string"))), " ")
    docs = spark.range(12_000).select(F.col("id").alias("doc_id"), F.concat_ws(" ", words, number).alias("text"))
    docs.selectExpr("doc_id", "cast(doc_id % 2 as int) AS quality").write.parquet(f"{tmp_path}/labels.parquet")
    seen = []
    monkeypatch.setattr(quality, "find_bar", lambda rated: seen.extend(rated.select("_key", "_mark").collect()))
    assert corpus_pipeline.by_quality(spark, docs, str(tmp_path)).columns == docs.columns
    assert sorted(tuple(r) for r in seen) == [(i, i % 2) for i in range(12_000)]
