"""Words of lines: each line is split once, and the quick way gives the words of the full rule."""
from pyspark.sql import functions as F

from hexatlas.llm import line_dedup


def test_quick_words_are_those_of_the_full_rule(spark):
    points = [c for c in range(1, 0x110000) if c != 10 and not 0xD800 <= c < 0xE000]
    rows = [(i, "é a" + chr(c) + "b " + chr(c)) for i, c in enumerate(points) if c < 0x3400 or c % 97 == 0 or 0xF900 <= c < 0x10000]
    rows += [(-1, ""), (-2, "  "), (-3, "a\t b\r"), (-4, None)]
    one = "".join(f"\\p{{Is{s}}}" for s in line_dedup.UNSPACED)
    full = F.filter(F.split(F.regexp_replace("line", f"([{one}])", " $1 "), "(?U)\\s+"), lambda w: w != "")
    lines = spark.createDataFrame(rows, "id long, line string")
    assert lines.where(~line_dedup._words("line").eqNullSafe(full)).count() == 0


def test_no_line_is_split_twice(spark):
    docs = spark.createDataFrame([(1, "one two three four five\n\nsix")], "doc_id long, text string")
    rows = line_dedup.lines(line_dedup.documents(docs), 5)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("regexp_replace(") == 1
    assert [len(r["halves"] or []) for r in rows.orderBy("i").collect()] == [2, 0]
