"""The pipeline's line dedup on lines of few words, other white space and scripts without spaces."""

import corpus_pipeline


def test_repeats_of_every_line_go(spark, tmp_path):
    tabs = "\t".join(f"cell{i}" for i in range(12))
    han = "這是一個沒有空格的句子重複出現"
    first = ["Read more", "one", tabs, han, "a b c d", ""]
    texts = ["\n".join(first), "\n".join(first), "one two\n" + tabs.replace("cell3", "other") + "\n" + han.replace("句", "詞") + "\nRead\tmore\n\nnew", None]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    got = {r["doc_id"]: r for r in corpus_pipeline.dedup_lines(spark, docs, str(tmp_path)).collect()}
    assert [got[i]["text"] for i in range(4)] == [texts[0], "", "one two\n\nnew", None]
    assert all(got[i]["n_chars"] == len(got[i]["text"]) for i in range(3))
