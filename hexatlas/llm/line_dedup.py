"""Line dedup by a deletion-neighbourhood join. DataFrame functions only.

A line is its words: what stands between white space of any kind, and each character of scripts without spaces. A line is dropped where
an earlier line has the same words, or, from NEAR_WORDS words on, lies within one word's insertion, deletion or substitution of an earlier
one that long. Earlier means by (doc_id, text hash, line number), null doc_ids last. The earlier line counts whether or not it is dropped
itself. Blank lines stay.

Every candidate line emits its variants with one word deleted, as hashed keys. Lines that share a variant deleted at the same place
differ by a substitution; a variant that is another line's full key is a deletion. Only the earliest line of each key is kept, so a
key shared by a third of all lines costs a row each, never their pairs. Candidates are lines that share their first or last half of
words with another line, which two lines within one edit always do. Links are verified on the words themselves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import discard, load, sieve, stash, unpacked, whole_row

NEAR_WORDS = 5
CLASS = ["k1", "k2"]  # two hashes of a line's words
PLACE = ["d", "t", "i"]  # doc_id (null: the largest long), hash of the text, number of the line in it
LAST = (1 << 63) - 1
UNSPACED = ("Han", "Hiragana", "Katakana", "Thai", "Lao", "Khmer", "Myanmar", "Tibetan")


# what no line of spaced words holds: wide white space, and all blocks that scripts without spaces may lie in
WIDE = "[\\x85\\xa0\\x{e00}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{2e80}-\\x{10ffff}]"


def _words(line: Column | str) -> Column:
    line = F.col(line) if isinstance(line, str) else line
    one = "".join(f"\\p{{Is{s}}}" for s in UNSPACED)
    wide = F.split(F.regexp_replace(line, f"([{one}])", " $1 "), "(?U)\\s+")
    plain = line
    for gap in "\t\x0b\f\r":
        plain = F.replace(plain, F.lit(gap), F.lit(" "))
    # the same where no character of WIDE stands, and quicker
    simple = (F.octet_length(line) == F.length(line)) | ~F.rlike(line, F.lit(WIDE))
    return F.filter(F.when(simple, F.split(plain, " ")).otherwise(wide), lambda w: w != "")


def documents(docs: DataFrame) -> DataFrame:
    """docs with its key (d, t). Rows equal in doc_id and text are one document: what one keeps the other keeps."""
    return docs.withColumns({"d": F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)), "t": F.xxhash64("text")})


def _half_keys(words: Column, n: Column) -> Column:
    """First and last h words for h = n/2 and (n-1)/2, so that lines one word apart in length meet."""
    def keys(h: Column) -> list[Column]:
        return [F.xxhash64(F.lit(0), h, F.slice(words, 1, h)), F.xxhash64(F.lit(1), h, F.slice(words, n - h + 1, h))]

    longer, shorter = F.floor(n / 2).cast("int"), F.floor((n - 1) / 2).cast("int")
    return F.array_distinct(F.array(*keys(longer), *keys(shorter)))


def lines(keyed: DataFrame, near_words: int) -> DataFrame:
    """Rows (d, t, i, k1, k2, halves): all lines but blank ones; halves is null below near_words."""
    split = keyed.select("d", "t", F.posexplode(F.split("text", "\n")).alias("i", "line"))
    # through a generator: a filter on plain columns would split every line a second time
    rows = split.select(*PLACE, F.explode(F.array(_words("line"))).alias("w"))
    n = F.size("w")
    return (rows.where(n >= 1)
            .select(*PLACE, F.xxhash64("w").alias("k1"), F.xxhash64(F.lit(7), "w").alias("k2"),
                    F.when(n >= near_words, _half_keys(F.col("w"), n)).alias("halves")))


def candidates(rows: DataFrame, classes: DataFrame, keyed: DataFrame) -> DataFrame:
    """Rows (id, k1, k2, w): the first occurrence, with its words, of each class that shares a half key with another class.

    Ids follow the order of places: a smaller id is an earlier line.
    """
    halves = rows.where("halves IS NOT NULL").select("k1", F.explode("halves").alias("half"))
    shared = stash(halves.groupBy("half").agg(F.min("k1").alias("_a"), F.max("k1").alias("_b")).where("_a <> _b").select("half"))
    chosen = sieve(halves, F.col("half"), shared).join(shared, "half").select("k1").distinct()
    wanted = stash(classes.join(chosen, "k1", "left_semi").select(*CLASS, "first"))
    place = F.xxhash64("first.d", "first.t")
    by_doc = wanted.groupBy(F.col("first.d").alias("d"), F.col("first.t").alias("t")).agg(
        F.collect_list(F.struct(*CLASS, "first")).alias("wanted"))  # no more than the document's own lines
    texts = sieve(keyed.select("d", "t", "text"), F.xxhash64("d", "t"), wanted.select(place.alias("doc")))
    one = texts.join(by_doc, ["d", "t"]).dropDuplicates(["d", "t"])
    found = (one.select(F.split("text", "\n").alias("all"), F.explode("wanted").alias("c"))
             .select("c.*", F.element_at("all", F.col("c.first.i") + 1).alias("line")))
    ordered = found.repartitionByRange("first.d", "first.t", "first.i").sortWithinPartitions("first.d", "first.t", "first.i")
    cand = stash(ordered.select(F.monotonically_increasing_id().alias("id"), *CLASS, _words("line").alias("w")))
    for done in (shared, wanted):
        discard(done)
    return cand


def variants(cand: DataFrame) -> DataFrame:
    """Rows (id, n, j, v): for j >= 0 the key of the line without word j, for j = -1 of the whole line.

    A key is a hash of two sums of hashes of each word with its place; running sums give all of a line's keys in linear time.
    """
    def placed(seed: int, place: Column) -> Column:
        return F.xxhash64(F.lit(seed), "h", place).bitwiseAND(F.lit((1 << 40) - 1))

    words = cand.select("id", F.posexplode(F.transform("w", lambda x: F.xxhash64(x))).alias("j", "h"))
    line = Window.partitionBy("id")
    upto = line.orderBy("j").rowsBetween(Window.unboundedPreceding, 0)
    sums = words.select("id", "j", F.count("*").over(line).cast("int").alias("n"),
                        *[F.sum(placed(s, F.col("j"))).over(upto).alias(f"own{s}") for s in (1, 2)],
                        *[placed(s, F.col("j")).alias(f"last{s}") for s in (1, 2)],
                        *[F.sum(placed(s, F.col("j") - 1)).over(upto).alias(f"moved{s}") for s in (1, 2)],
                        *[F.sum(placed(s, F.col("j") - 1)).over(line).alias(f"all{s}") for s in (1, 2)])
    cut = F.xxhash64(*[F.col(f"own{s}") - F.col(f"last{s}") + F.col(f"all{s}") - F.col(f"moved{s}") for s in (1, 2)])
    whole = F.when(F.col("j") == F.col("n") - 1, F.xxhash64("own1", "own2"))
    both = F.array(F.struct("j", cut.alias("v")), F.struct(F.lit(-1).alias("j"), whole.alias("v")))
    return sums.select("id", "n", F.explode(both).alias("e")).select("id", "n", "e.j", "e.v").where("v IS NOT NULL")


def links(cand: DataFrame) -> DataFrame:
    """Rows (id, other, j): a line and the earliest found within one edit; j the word deleted from the longer, -1: substituted."""
    keys = stash(variants(cand))
    cut, whole = keys.where("j >= 0"), keys.where("j < 0")
    near = stash(cut.groupBy("v", "j").agg(F.min("id").alias("other"), F.count("*").alias("_n")).where("_n > 1").drop("_n"))
    replaced = (sieve(cut, F.col("v"), near.select("v")).join(near, ["v", "j"]).where("other < id")
                .select("id", "other", F.lit(-1).alias("j")))
    short = stash(whole.select("v", (F.col("n") + 1).alias("n"), F.col("id").alias("short")))
    met = sieve(cut, F.col("v"), short.select("v")).join(short, ["v", "n"])
    longer = met.where("short < id").select("id", F.col("short").alias("other"), "j")
    shorter = (met.where("id < short").groupBy("short").agg(F.min(F.struct("id", "j")).alias("m"))
               .select(F.col("short").alias("id"), F.col("m.id").alias("other"), F.col("m.j").alias("j")))
    out = stash(replaced.unionByName(longer).unionByName(shorter).groupBy("id", "j").agg(F.min("other").alias("other")))
    for done in (keys, near, short):
        discard(done)
    return out


def verified(found: DataFrame, cand: DataFrame) -> DataFrame:
    """The classes (k1, k2) of which a link holds on the words."""
    own = cand.select("id", *CLASS, F.col("w").alias("a"))
    theirs = cand.select(F.col("id").alias("other"), F.col("w").alias("b"))
    pair = found.join(own, "id").join(theirs, "other")

    def without(w: Column, j: Column) -> Column:
        return F.concat(F.slice(w, F.lit(1), j), F.slice(w, j + 2, F.greatest(F.size(w) - j - 1, F.lit(0))))

    a, b, j = F.col("a"), F.col("b"), F.col("j")
    differ = F.size(F.filter(F.zip_with(a, b, lambda x, y: ~x.eqNullSafe(y)), lambda d: d))
    edited = (F.when(j < 0, (F.size(a) == F.size(b)) & (differ <= 1))
              .when(F.size(a) > F.size(b), without(a, j) == b).otherwise(without(b, j) == a))
    return pair.where(edited).select(*CLASS).distinct()


def dropped(docs: DataFrame, near_words: int = NEAR_WORDS) -> DataFrame:
    """Rows (d, t, drop), a written table: for each document that loses lines, their numbers in order."""
    keyed = documents(docs)
    rows = stash(lines(keyed, near_words))
    classes = stash(rows.groupBy(*CLASS).agg(F.min(F.struct(*PLACE)).alias("first"), F.count("*").alias("n")))
    cand = candidates(rows, classes, keyed)
    found = links(cand)
    late = stash(verified(found, cand).withColumn("late", F.lit(True)))
    marked = stash(classes.where("n > 1").join(late, CLASS, "left").unionByName(classes.where("n = 1").join(late, CLASS))
                   .select(*CLASS, "first", "late"))
    hit = (sieve(rows.select(*PLACE, *CLASS), F.col("k1"), marked.select("k1")).join(marked, CLASS)
           .where(F.col("late") | (F.struct(*PLACE) != F.col("first"))))
    out = stash(hit.groupBy("d", "t").agg(F.sort_array(F.collect_set("i")).alias("drop")))
    for done in (rows, classes, cand, found, late, marked):
        discard(done)
    return out


def dedup_lines(docs: DataFrame, near_words: int = NEAR_WORDS) -> DataFrame:
    """docs with the dropped lines cut out of text (and n_chars, if there, counted anew); all rows, the columns of docs.

    Null texts stay null and empty ones empty; a text may become empty. Repeated rows lose the same lines. Empty table: no rows.
    """
    keyed = docs.select(whole_row(docs).alias("row"), F.coalesce(docs["doc_id"].cast("long"), F.lit(LAST)).alias("d"),
                        F.xxhash64(docs["text"]).alias("t"))
    drops = dropped(docs.select("doc_id", "text"), near_words)
    key, member = F.xxhash64("d", "t"), drops.select(F.xxhash64("d", "t").alias("doc"))
    touched = sieve(keyed, key, member).join(drops, ["d", "t"], "left")
    kept = F.array_join(F.filter(F.split("row.text", "\n"), lambda x, i: ~F.array_contains("drop", i)), "\n")
    text = F.when(F.col("drop").isNull(), F.col("row.text")).otherwise(kept)
    done = touched.select("row", text.alias("_text")).unionByName(
        sieve(keyed, key, member, out=True).select("row", F.col("row.text").alias("_text")))
    changed = {"text": F.col("_text")}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(F.col("_text").isNull(), F.col("row.n_chars")).otherwise(F.length("_text").cast("long"))
    return unpacked(done, "row", docs, changed)


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: doc_id, its number of lines (null text: none), how many are dropped, and their numbers from 0."""
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    every = documents(docs).select("doc_id", "d", "t", F.coalesce(F.size(F.split("text", "\n")), F.lit(0)).cast("long").alias("n_lines"))
    found = every.join(dropped(docs), ["d", "t"], "left")
    return found.select("doc_id", "n_lines", F.coalesce(F.size("drop"), F.lit(0)).cast("long").alias("n_dropped"),
                        F.coalesce(F.array_join("drop", ","), F.lit("")).alias("dropped"))


def op2_sql() -> str:
    one = "".join(f"\\p{{{s}}}" for s in UNSPACED)
    return f"""
WITH lines AS (
  SELECT doc_id, generate_subscripts(l, 1) - 1 AS i, unnest(l) AS line
  FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents)),
words AS (
  SELECT doc_id, i, list_filter(regexp_split_to_array(regexp_replace(line, '([{one}])', ' \\1 ', 'g'), '[\\t\\n\\x0B\\f\\r\\x{{85}}\\p{{Z}}]+'),
    lambda w: w <> '') AS w FROM lines),
usable AS (SELECT * FROM words WHERE len(w) > 0),
classes AS (SELECT w, min((doc_id, i)) AS first FROM usable GROUP BY w),
places AS (SELECT w, first, unnest(range(len(w))) AS j FROM classes WHERE len(w) >= {NEAR_WORDS}),
cuts AS (SELECT w, first, j, list_concat(w[:j], w[j + 2:]) AS v FROM places),
near AS (
  SELECT w, other FROM (SELECT w, min(first) OVER (PARTITION BY v, j) AS other FROM cuts)
  UNION ALL SELECT c.w, s.first FROM cuts c JOIN classes s ON c.v = s.w WHERE len(s.w) >= {NEAR_WORDS}
  UNION ALL SELECT s.w, c.first FROM cuts c JOIN classes s ON c.v = s.w WHERE len(s.w) >= {NEAR_WORDS}),
late AS (SELECT DISTINCT w FROM near JOIN classes USING (w) WHERE other < first),
gone AS (
  SELECT u.doc_id, u.i FROM usable u JOIN classes c ON u.w = c.w
  WHERE (u.doc_id, u.i) <> c.first OR u.w IN (SELECT w FROM late)),
lists AS (SELECT doc_id, count(*) AS n, string_agg(i::VARCHAR, ',' ORDER BY i) AS l FROM gone GROUP BY doc_id)
SELECT d.doc_id, coalesce(len(string_split(d.text, chr(10))), 0)::BIGINT AS n_lines, coalesce(n, 0)::BIGINT AS n_dropped,
  coalesce(l, '') AS dropped
FROM documents d LEFT JOIN lists USING (doc_id)"""
