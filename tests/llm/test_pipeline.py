import public_tokenizers
import sentencepiece
from test_ngram_join import brute

import __spark_entry__
import corpus_pipeline


def test_registered():
    assert __spark_entry__.queries()["pipeline"] is corpus_pipeline.run and len(corpus_pipeline.STAGES) == 5
    assert {int(n[2:].split("_")[0]) for n in __spark_entry__.queries() if n.startswith("op")} == set(range(1, 14))


def test_stages_on_a_table_with_edge_cases(spark, documents, tmp_path):
    words = " ".join(f"wort{i}" for i in range(60))
    rows = [(1, words, "de", "a", 3), (2, words + " ende", "de", "b", 3), (2, words + " ende", "de", "b", 3), (3, None, None, None, None), (4, "12 34", None, "a", 1), (None, "ein anderer Text mit Wörtern " * 9, "de", None, 1),
            (5, "the mail is a.b@c.org and the house of the dog", "en", "a", 1), (6, "the cat sat on the mat and the dog ran", "en", "b", 2), (7, "", "en", "c", 0)]
    docs = documents(*[r + ("keep",) for r in rows], extra=", label string")
    left = docs
    out = []
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, left, str(tmp_path)).write.parquet(f"file://{tmp_path}/{number}")
        left = spark.read.parquet(f"file://{tmp_path}/{number}")
        out.append(left)
        if number < 4:
            assert left.columns == docs.columns
    named, distinct, private, mixed, coded = ([r.asDict() for r in d.collect()] for d in out)
    assert sorted(str(r["doc_id"]) for r in named) == ["1", "2", "2", "5", "6", "None"]
    assert sorted(str(r["doc_id"]) for r in distinct) == ["1", "5", "6", "None"]
    assert not any("a.b@c.org" in r["text"] for r in private) and all(r["n_chars"] == len(r["text"]) for r in private)
    assert all(r in private for r in mixed)
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    assert sorted((str(r["doc_id"]), r["ids"]) for r in coded) == sorted((str(r["doc_id"]), sp.encode(r["text"], add_bos=True, add_eos=True)) for r in mixed)
    assert all(r["round_trip"] for r in coded)


def test_near_duplicates_leave_one_row_per_class(spark, small_docs, sf_small):
    kept = {r["doc_id"] for r in corpus_pipeline.drop_near_duplicates(spark, small_docs, sf_small).collect()}
    rows = [(r["doc_id"], r["text"]) for r in small_docs.collect()]
    assert kept == {d for (d, _), (_, c) in zip(rows, brute(rows)) if d == c}


def test_run_over_the_table(spark, sf_small):
    out = corpus_pipeline.run(spark, sf_small)
    assert out.columns == ["doc_id", "n_tokens", "ids", "round_trip"] and out.where("not round_trip").count() == 0
    assert out.count() > spark.read.parquet(f"{sf_small}/documents.parquet").count()


def test_empty_table(spark, documents, tmp_path):
    left = documents().limit(0)
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, left, str(tmp_path)).write.parquet(f"file://{tmp_path}/{number}")
        left = spark.read.parquet(f"file://{tmp_path}/{number}")
    assert left.count() == 0


def test_texts_of_unlearned_languages_go_and_clean_ones_stay(spark, documents):
    from pyspark.sql import functions as F

    known = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    odd = ["Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan.", "Bütün insanlar hür, haysiyet ve haklar bakımından eşit doğarlar.", "すべての人間は、生まれながらにして自由であり、かつ、尊厳と権利とについて平等である。",
           "Все люди рождаются свободными и равными в своем достоинстве и правах.", "xkq zvvw qjxz bbkt wqpz jjx kkz vvbq xzqw"]
    left = corpus_pipeline.keep_languages(spark, known.union(documents(*[(-1 - i, t) for i, t in enumerate(odd)] + [(-100, "the cat sat on the mat and the dog ran")])), "")
    assert {r["doc_id"] for r in left.where("doc_id < 0").collect()} == {-100}
    assert left.where("doc_id >= 0").count() > 0.99 * known.where("text is not null").count()
    # Three learned languages of two families: German goes as a whole, nearly all else stays.
    german = corpus_pipeline.keep_languages(spark, known.withColumn("lang", F.expr("if(lang = 'de', null, lang)")), "").select("doc_id")
    share = known.join(german.withColumn("kept", F.lit(True)), "doc_id", "left").groupBy((F.col("lang") == "de").alias("de")).agg(F.avg(F.coalesce("kept", F.lit(False)).cast("int")).alias("s"))
    share = {r["de"]: r["s"] for r in share.collect()}
    assert share[True] < 0.1 and share[False] > 0.99
