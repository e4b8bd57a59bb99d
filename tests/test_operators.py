"""Operators on small fixtures, against brute force."""

import json
import re

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as hs
from pyspark.sql import functions as F

from corpus_mt.operators import evaluate as ev
from corpus_mt.operators import layout as ly
from corpus_mt.operators import replace as rp
from corpus_mt.operators import sentences as sn
from corpus_mt.operators import template as tp
from corpus_mt.operators import tokens as tk
from corpus_mt.operators import translate as tr
from corpus_mt.operators.skew import spread_join

SLOW = settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))


@pytest.mark.parametrize("partitions", [1, 8])
def test_numbers_are_contiguous_and_ordered(spark, partitions):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k")).repartition(partitions)
    rows = ly.number_rows(df, ["k"]).collect()
    assert sorted((r.row_idx, r.k) for r in rows) == [(i, i) for i in range(1000)]


def test_numbers_with_a_hot_key(spark):
    """A third of the rows share one key, and many rows are equal throughout."""
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id") % 50).alias("k"))
    rows = ly.number_rows(df, ["k"], start=10).collect()
    assert sorted(r.row_idx for r in rows) == list(range(10, 3010))
    assert [r.k for r in sorted(rows, key=lambda r: r.row_idx)] == sorted(r.k for r in rows)


def test_hot_key_spreads_over_partitions(spark):
    df = spark.range(20_000).select(F.lit(1).alias("k"))
    sizes = ly.sort_rows(df, ["k"]).groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert max(r["count"] for r in sizes) < 20_000 or len(sizes) == 1


def test_numbers_of_an_empty_table(spark):
    assert ly.number_rows(spark.range(0), ["id"]).columns == ["id", "row_idx"]
    assert ly.number_rows(spark.range(0), ["id"]).count() == 0


@pytest.mark.parametrize(
    ("split", "n", "want"),
    [
        ("train", 10, None),
        ("train[]", 10, None),
        ("train[:]", 10, None),
        ("train[2:5]", 10, (2, 5)),
        ("train[:5]", 10, (0, 5)),
        ("train[5:]", 10, (5, 10)),
        ("train[:25%]", 10, (0, 2)),
        ("train[50%:]", 11, (5, 11)),
        ("train[10%:20%]", 100, (10, 20)),
        ("train[5:2]", 10, None),
        ("train[0:99]", 10, None),
    ],
)
def test_split_ranges(split, n, want):
    assert sn.parse_split(split, n) == want


def test_split_slice(spark):
    got = sn.split_slice(spark.range(10), "train[20%:50%]", ("id",)).collect()
    assert sorted(r.id for r in got) == [2, 3, 4]


def test_ranks_are_contiguous(spark):
    rows = ly.assign_rank(spark.range(11).withColumnRenamed("id", "tlt_idx"), 4, 11).orderBy("tlt_idx").collect()
    assert [r["rank"] for r in rows] == [0, 0, 0, 1, 1, 1, 2, 2, 2, 3, 3]


def test_reroot(spark):
    df = spark.sql("select explode(array('/a/b/c/d', 'd')) p")
    assert [r[0] for r in df.select(ly.reroot_path(F.col("p"), "/x/")).collect()] == ["/x/c/d", "/x/d"]


def vocab(spark, *words):
    table = [(t, i) for i, t in enumerate(["<s>", "<pad>", "</s>", "<unk>", "eng_Latn", "hin_Deva", *words])]
    df = spark.createDataFrame(table, "token string, id int")
    return tk.Vocabulary(df, df)


def test_padding_cases(spark):
    v = vocab(spark, "▁a", "▁b")
    df = spark.createDataFrame([(0, "eng_Latn hin_Deva"), (1, "eng_Latn hin_Deva a zz")], "tlt_idx long, line string")
    rows = tk.tokenize_batch(df, v, "line", with_length=True).orderBy("tlt_idx").collect()
    assert [r.input_ids for r in rows] == [[1, 1, 4, 5, 2], [4, 5, 6, 3, 2]]
    assert [r.attention_mask for r in rows] == [[0, 0, 1, 1, 1], [1, 1, 1, 1, 1]]
    assert [r.lengths for r in rows] == [2, 4]
    with pytest.raises(ValueError):
        tk.tokenize_batch(df, v, "line", padding="no")


def test_max_length_cuts_and_pads(spark):
    v = vocab(spark, "▁a")
    df = spark.createDataFrame([(0, "eng_Latn hin_Deva " + "a " * 400), (1, "eng_Latn hin_Deva a")], "tlt_idx long, line string")
    rows = tk.tokenize_batch(df, v, "line", truncation=True, padding="max_length").orderBy("tlt_idx").collect()
    assert [len(r.input_ids) for r in rows] == [256, 256] and rows[0].input_ids.count(6) == 253
    assert sum(rows[1].attention_mask) == 4


def test_large_vocabulary_path_gives_the_same(spark):
    v = vocab(spark, "▁a", "▁b")
    data = [(0, ["▁a", "▁zz", "▁b"]), (1, []), (2, None), (3, ["▁a"] * 50)]
    df = spark.createDataFrame(data, "tlt_idx int, tokens array<string>")
    small = {r.tlt_idx: r.input_ids for r in tk.encode_ids(df, v).collect()}
    large = {r.tlt_idx: r.input_ids for r in tk.encode_ids(df, v, max_broadcast=0).collect()}
    assert small == large == {0: [6, 3, 7], 1: [], 2: None, 3: [6] * 50}
    ids = spark.createDataFrame([(0, [6, 99, 2, 7, 3])], "tlt_idx int, i array<int>")
    both = [tk.decode_text(ids, v, "i", "o", max_broadcast=m).first().o for m in (0, 100)]
    assert both == ["a<unk> b<unk>"] * 2


def test_vocabulary_size_changes_nothing(spark):
    """Repeated row keys, a token listed twice, an id of two tokens, and one token in most places."""
    fixed = [("<s>", 0), ("<pad>", 1), ("</s>", 2), ("<unk>", 3)]
    table = spark.createDataFrame([*fixed, ("▁a", 4), ("▁a", 5), ("▁b", 6), ("▁c", 6)], "token string, id int")
    v = tk.Vocabulary(table, table)
    df = spark.createDataFrame([(7, ["▁a"]), (7, ["▁b", "▁c"]), (7, None), (7, ["▁a"] * 300 + ["?"])], "tlt_idx int, tokens array<string>")
    got = [sorted((r.input_ids or [-1]) for r in tk.encode_ids(df, v, max_broadcast=m).collect()) for m in (0, 100)]
    assert got[0] == got[1] == sorted([[4], [6, 6], [-1], [4] * 300 + [3]])
    ids = spark.createDataFrame([(1, [4, 6]), (1, [5, 6])], "tlt_idx int, i array<int>")
    got = [sorted(r.t for r in tk.decode_tokens(ids, v, "i", "t", max_broadcast=m).collect()) for m in (0, 100)]
    assert got[0] == got[1] == [["<unk>", "▁b"], ["▁a", "▁b"]]


def test_missing_specials(spark):
    df = spark.createDataFrame([("a", 0)], "token string, id int")
    with pytest.raises(KeyError):
        tk.Vocabulary(df, df).require_specials()


def test_repad_and_drop_last(spark):
    df = spark.createDataFrame(
        [(0, [5, 2], [1, 1]), (1, [5, 6, 7, 2], [1] * 4), (2, [9, 2], [1, 1])],
        "tlt_idx long, input_ids array<int>, attention_mask array<int>",
    )
    rows = tk.repad_batch(df, 2).orderBy("tlt_idx").collect()
    assert [r.input_ids for r in rows] == [[1, 1, 5, 2], [5, 6, 7, 2], [9, 2]]
    assert rows[0].attention_mask == [0, 0, 1, 1]
    assert tk.repad_batch(df, 2, drop_last=True).count() == tk.drop_last_batch(df, 2).count() == 2


def test_source_text_drops_tags(spark):
    df = spark.sql("select array('eng_Latn','hin_Deva','▁a','b') t, array('▁a') u")
    assert tuple(df.select(tk.tokens_to_text(F.col("t"), True), tk.tokens_to_text(F.col("u"), True)).first()) == ("ab", "a")


def test_subword_model(spark, tmp_path):
    spm = pytest.importorskip("sentencepiece")
    text = tmp_path / "t.txt"
    text.write_text("\n".join(["the cat sat on the mat", "a dog ran in the park", "cats and dogs"] * 20))
    spm.SentencePieceTrainer.train(input=str(text), model_prefix=str(tmp_path / "m"), vocab_size=40, hard_vocab_limit=False, minloglevel=2)
    want = spm.SentencePieceProcessor(model_file=str(tmp_path / "m.model")).encode("the dog sat", out_type=str)
    df = spark.sql("select 'eng_Latn hin_Deva the dog sat' t")
    got = df.select(tk.tokenize(F.col("t"), True, tk.subword_pieces(str(tmp_path / "m.model")))).first()[0]
    assert got == ["eng_Latn", "hin_Deva", *want]


def test_translator_batches(spark):
    """The translator sees padded batches of the size asked for and is made once per task."""

    def make():
        calls = []

        def run(ids, masks):
            calls.append(ids.shape)
            assert ids.shape == masks.shape and len(ids) <= 3
            return [[len(calls), int(m.sum())] for m in masks]

        return run

    df = spark.createDataFrame(
        [(i, [7] * (i % 4 + 1), [1] * (i % 4 + 1)) for i in range(10)],
        "tlt_idx long, input_ids array<int>, attention_mask array<int>",
    ).coalesce(1)
    out = tr.translate_ids(df, make, batch_rows=3).collect()
    assert {r.tlt_idx: r.translated_input_ids[1] for r in out} == {i: i % 4 + 1 for i in range(10)}
    assert max(r.translated_input_ids[0] for r in out) == 4 and out[0].input_ids == [7]


def test_spread_join_splits_frequent_keys(spark):
    """One key with 30 % of the rows, one just over an even share, null keys."""
    key = F.when(F.col("id") < 3000, "hot").when(F.col("id") < 4300, "warm").when(F.col("id") > 9900, None).otherwise(F.col("id").cast("string"))
    left = spark.range(10_000).withColumn("k", key).repartition(4)
    right = left.select("k").distinct().withColumn("v", F.upper("k"))
    joined = spread_join(left, right, "k")
    assert joined.count() == 10_000 and joined.filter("k IS NOT NULL AND NOT v <=> upper(k)").count() == 0
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = spread_join(left, right, "k").filter("k IS NOT NULL").groupBy(F.spark_partition_id().alias("p")).agg(F.max(F.col("k") == "hot"), F.count("*").alias("n"))
        assert max(r.n for r in sizes.collect()) < 3000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_fan_out_splits_a_hot_sentence(spark):
    rows = spark.range(3000).select(
        F.col("id").cast("string").alias("doc_id"), F.lit(0).alias("pos"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), "id")).alias("sub_str"),
    ).withColumn("sid", F.sha2("sub_str", 256))
    got = tr.translate_distinct(rows, lambda d: d.withColumn("translated", F.upper("sub_str")))
    assert got.count() == 3000 and got.filter(F.col("translated") != F.upper("sub_str")).count() == 0


def py_replace(text, keys, values):
    table = dict(zip(keys, values))
    return re.sub("|".join(map(re.escape, table)), lambda m: table[m.group(0)], text) if table else text


@SLOW
@given(
    hs.lists(
        hs.tuples(
            hs.text(alphabet="ab. (*é", max_size=30),
            hs.lists(hs.text(alphabet="ab. (*é", min_size=1, max_size=4), unique=True, max_size=6),
        ),
        min_size=20,
        max_size=40,
    )
)
def test_replace_like_one_regex_pass(spark, cases):
    data = [(i, t, k, [f"<{x}>" for x in k]) for i, (t, k) in enumerate(cases)]
    df = spark.createDataFrame(data, "i int, t string, k array<string>, v array<string>")
    got = df.select("i", rp.replace_substrings(F.col("t"), F.col("k"), F.col("v")).alias("o")).orderBy("i").collect()
    want = [py_replace(t, k, v) for _, t, k, v in data]
    assert [r.o for r in got] == want


def test_replace_order_case(spark):
    df = spark.sql("select 'a b. a b c' t, array('a b','a b c','b.') k, array('X b.','Y','Z') v")
    assert df.select(rp.replace_substrings(F.col("t"), F.col("k"), F.col("v"))).first()[0] == "X b.. X b. c"


def test_replace_documents_with_copies_and_gaps(spark):
    raw = spark.createDataFrame([("d1", "One. Two."), ("d1", "One. Two."), ("d2", "Three."), ("d3", "***")], "id string, content string")
    docs = tp.template_documents(raw, id_col="id")
    sent = sn.explode_sentences(docs).withColumn("translated", F.when(F.col("sub_str") != "three.", F.upper("sub_str")))
    by_pos = rp.replace_documents(docs, sent).collect()
    by_sid = rp.replace_documents(docs, sent.select("doc_id", "sid", "translated")).collect()
    want = [("d1", "ONE. TWO.", ["ONE.", "TWO."])] * 2 + [("d2", "three.", ["None"]), ("d3", "***", ["None"])]
    for rows in (by_pos, by_sid):
        assert sorted((r.doc_id, r.translated, r.substr_tlt) for r in rows) == want
    same = rp.replace_documents(docs, sent.withColumn("translated", F.col("sub_str")))
    assert same.filter("translated != text").count() == 0


def test_path_lookup(spark):
    docs = spark.createDataFrame([("d", "/base/x/d", ["s1", "s2"], ["a", "b"])], "doc_id string, tlt_folder string, sids array<string>, sub_strs array<string>")
    table = spark.createDataFrame([("/other/d/s2", "B")], "path string, translated string")
    rows = rp.lookup_translations(docs, table, "/other").collect()
    assert [(r.pos, r.sub_str, r.translated) for r in rows] == [(1, "b", "B")]


def test_lookup_of_copies_and_of_uris(spark):
    docs = spark.createDataFrame([("d", "/base/d", ["s1", "s2"], ["a", "b"])] * 20, "doc_id string, tlt_folder string, sids array<string>, sub_strs array<string>")
    stored = sn.explode_sentences(docs).select(F.concat(F.lit("file://host"), "tlt_file_loc").alias("path"), F.upper("sub_str").alias("translated"))
    assert stored.count() == 40
    rows = rp.lookup_translations(docs, stored).collect()
    assert len(rows) == 40 and {(r.sub_str, r.translated) for r in rows} == {("a", "A"), ("b", "B")}


def test_scores_with_null_and_repeated_rows(spark):
    rows = [("x", "a b c d", "a b c d"), ("x", "a b c d", "a b c d"), ("x", None, "a"), ("y", "", None)]
    df = spark.createDataFrame(rows, "g string, prediction string, reference string")
    bleu = {r.g: r.bleu for r in ev.corpus_bleu(df, ["g"]).collect()}
    chrf = {r.g: r.chrf for r in ev.corpus_chrf(df, ["g"]).collect()}
    assert bleu["x"] == pytest.approx(100 * np.exp(1 - 9 / 8)) and bleu["y"] == chrf["y"] == 0.0 and 90 < chrf["x"] < 100
    plan = ev.corpus_chrf(df, ["g"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Generate" not in plan


def test_evaluation_scores(spark):
    df = spark.createDataFrame([(1, "a b c d e", "a b c d e"), (2, "x y z w", "x y z w")], "id int, prediction string, reference string")
    assert ev.corpus_bleu(df).first().bleu == pytest.approx(100)
    assert ev.corpus_chrf(df).first().chrf == pytest.approx(100)
    none = df.withColumn("prediction", F.lit("q q q q"))
    assert ev.corpus_bleu(none).first().bleu == 0.0 and ev.corpus_chrf(none).first().chrf == 0.0


def test_bleu_by_hand(spark):
    df = spark.createDataFrame([(1, "the cat sat on mat", "the cat sat on the mat")], "id int, prediction string, reference string")
    want = 100 * np.exp(1 - 6 / 5) * np.exp(np.mean(np.log([5 / 5, 3 / 4, 2 / 3, 1 / 2])))
    assert ev.corpus_bleu(df).first().bleu == pytest.approx(want)


def test_long_and_wide_forms(spark):
    wide = spark.createDataFrame([(1, "a", "b")], "id int, sentence_eng_Latn string, sentence_hin_Deva string")
    assert sorted((r.lang, r.sentence) for r in ev.long_form(wide).collect()) == [("eng_Latn", "a"), ("hin_Deva", "b")]
    pairs = [("eng_Latn", "hin_Deva"), ("hin_Deva", "hin_Deva"), ("hin_Deva", "eng_Latn")]
    rows = ev.pair_sentences(wide, pairs)
    assert sorted((r.src_lang, r.source, r.reference) for r in rows.collect()) == [("eng_Latn", "a", "b"), ("hin_Deva", "b", "a")]
    back = ev.wide_form(rows.withColumn("prediction", F.upper("source")), pairs[::2]).first()
    assert back["tlt-eng_Latn__hin_Deva"] == "A" and back["tlt-hin_Deva__eng_Latn"] == "B"


def test_model_output_columns(spark):
    df = spark.sql(
        "select 'd' doc_id, array(1,2) input_ids, 's' sid, 'x' sub_str, 0L tlt_idx, 'p' tlt_file_loc, "
        "array(2) translated_input_ids, array(struct(1 serial, 'e' entity)) entities"
    )
    row = tr.model_output(df).first()
    assert tuple(row.asDict()) == tr.MODEL_OUTPUT_COLUMNS
    assert json.loads(row.placeholder_entity_map)["<ID1>"] == "e"


def test_only_ids_and_masks_go_to_the_translator(spark):
    """Texts beside the ids stay where they are, and rows without ids in between do no harm."""
    rows = [(i, "x" * 50, [1] * (4 - i % 4) + list(range(5, 5 + i % 4)), [0] * (4 - i % 4) + [1] * (i % 4)) for i in range(10)]
    df = spark.createDataFrame(rows, "k int, text string, input_ids array<int>, attention_mask array<int>").coalesce(1)

    def make():
        def run(ids, masks):
            ids[:] += 1  # a translator may write into what it is given
            return [row[m == 1].tolist() for row, m in zip(ids, masks)]

        return run

    out = tr.translate_ids(df, make, batch_rows=3)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" not in plan and "ArrowEvalPython" in plan
    assert out.columns == ["k", "text", "input_ids", "translated_input_ids"]
    got = {r.k: (list(r.input_ids), list(r.translated_input_ids)) for r in out.collect()}
    assert got == {k: (ids, [x + 1 for x, m in zip(ids, mask) if m]) for k, _, ids, mask in rows}


def test_tagged_words_with_odd_spaces(spark):
    lines = ["a b c d", "a b", "a", "", "a b  c", "a b c ", "a b ", "  c d", "a  c d"]
    tags = [(x.split(" ")[:2], x.split(" ")[2:]) for x in lines]
    want = [t + [tk.WORD_START + w for w in rest if w] for t, rest in tags]
    df = spark.createDataFrame(list(enumerate(lines)), "i int, t string").orderBy("i")
    assert [list(r[0]) for r in df.select(tk.tokenize(F.col("t"))).collect()] == want
