"""Benchmark decontamination by winnowing (DataFrame functions only).

Texts become words; every window of ``w`` consecutive k-grams keeps its least
hash. Two texts that share ``k + w - 1`` words share a kept hash, so joining the
fingerprints of documents and items finds every shared span of that length. A
hit gives a diagonal (document position minus item position), along which the
item is compared word by word; runs of at least ``span`` equal words count, and
items of fewer words must stand there whole. With k = 8 and w = 6 the guarantee
is 13 words, the default ``span``. Items of fewer than ``span`` words use
k-grams of their own length and windows of one, so none of them is missed.

Fingerprints hash words in lower case of every alphabet, which only adds
candidates; the comparison folds A-Z alone.

Defined results: null text has no words; a document or item without words has
no hits; repeated rows come back as often as they came, repeated items count by
their item_id; a null doc_id stays null, a null item_id counts as an item whose
id is the empty string; empty tables give no hits. Only the id and
text columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import stored

SPAN = 13
GRAM = 8
#: Item fingerprints are broadcast up to this many rows (about 40 bytes each).
BROADCAST_ROWS = 200_000

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SEPARATORS, -1), "")


def grams(hashes: Column, k: int) -> Column:
    """Hash of the k words from each position; empty if there are fewer."""
    return F.when(F.size(hashes) >= k, F.transform(F.sequence(F.lit(1), F.size(hashes) - (k - 1)), lambda i: F.xxhash64(F.slice(hashes, i, k)))).otherwise(F.array().cast("array<bigint>"))


def kept(gram_hashes: Column, w: int) -> Column:
    """Distinct least hashes of all windows of w neighbours."""
    if w == 1:
        return F.array_distinct(gram_hashes)
    return F.when(F.size(gram_hashes) >= w, F.array_distinct(F.transform(F.sequence(F.lit(1), F.size(gram_hashes) - (w - 1)), lambda i: F.array_min(F.slice(gram_hashes, i, w))))).otherwise(F.array().cast("array<bigint>"))


def word_hashes(ws: Column) -> Column:
    return F.transform(ws, lambda x: F.xxhash64(F.lower(x)))


def contaminated_words(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text", item_text: str = "text", span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """(doc_id, text_hash, n_words, n_hit, items array<string>) of every
    document row: its number of words, of words inside occurring windows, and
    the sorted ids of items with such windows."""
    if not 0 < gram <= span:
        raise ValueError("gram must be between 1 and span")
    fold = lambda c: F.translate(c, UPPER, LOWER)

    item_rows = items.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item_id"), words(fold(F.col(item_text).cast("string"))).alias("item_words")).where(F.size("item_words") > 0).dropDuplicates()
    item_rows = stored(item_rows.withColumn("item", F.monotonically_increasing_id()), "items")  # numbered when written
    short = sorted(r[0] for r in item_rows.select(F.size("item_words").alias("n")).where(F.col("n") < span).distinct().collect())  # fewer than span numbers
    classes = [(gram, span - gram + 1), *((n, 1) for n in short)]
    of_item = []
    for i, (k, w) in enumerate(classes):
        chosen = item_rows.where(F.size("item_words") >= span if i == 0 else F.size("item_words") == k)
        gs = chosen.select("item", word_hashes(F.col("item_words")).alias("h")).select("item", grams(F.col("h"), k).alias("g"))
        places = gs.select("item", F.posexplode("g").alias("item_pos", "fp"))
        if w > 1:
            places = places.join(gs.select("item", F.explode(kept(F.col("g"), w)).alias("fp")), ["item", "fp"], "left_semi")
        of_item.append(places.select(F.lit(k).alias("k"), "fp", "item", "item_pos"))
    prints = of_item[0]
    for x in of_item[1:]:
        prints = prints.unionByName(x)
    prints = stored(prints, "item-prints")
    small = prints.count() <= BROADCAST_ROWS  # four numbers a row
    checked = F.broadcast if small else (lambda df: df)

    # 1: fingerprints of all documents, joined with the items'
    key = [F.col(doc_id).alias("doc_id"), F.xxhash64(F.col(text)).alias("text_hash")]
    ws = docs.select(*key, words(F.col(text).cast("string")).alias("w"))
    ws = ws.select("doc_id", "text_hash", F.size("w").cast("long").alias("n_words"), F.when(F.size("w") >= (span if not short else short[0]), word_hashes(F.col("w"))).alias("h"))
    gs = ws.select("doc_id", "text_hash", "n_words", "h", F.when(F.col("n_words") >= span, grams(F.col("h"), gram)).alias("g"))
    sets = [F.struct(F.lit(gram).alias("k"), F.coalesce(kept(F.col("g"), span - gram + 1), F.array().cast("array<bigint>")).alias("fps"))]
    sets += [F.struct(F.lit(n).alias("k"), F.coalesce(F.array_distinct(grams(F.col("h"), n)), F.array().cast("array<bigint>")).alias("fps")) for n in short]
    base = stored(gs.select("doc_id", "text_hash", "n_words", F.array(*sets).alias("prints")), "doc-prints")
    each = base.select("doc_id", "text_hash", F.explode("prints").alias("p")).select("doc_id", "text_hash", F.col("p.k").alias("k"), F.explode("p.fps").alias("fp"))
    candidates = stored(each.join(checked(prints.select("k", "fp").distinct()), ["k", "fp"], "left_semi").select("doc_id", "text_hash").distinct(), "candidates")

    # 2: the candidates' words; diagonals of their hits
    same = F.col("t.doc_id").eqNullSafe(F.col("c.doc_id")) & (F.col("t.text_hash") == F.col("c.text_hash"))
    texts = docs.select(*key, F.col(text).cast("string").alias("text")).where(F.col("text").isNotNull())
    texts = texts.alias("t").join(candidates.hint("shuffle_hash").alias("c"), same, "left_semi")
    texts = stored(texts.select("doc_id", "text_hash", words(fold(F.col("text"))).alias("w")).dropDuplicates(["doc_id", "text_hash"]).withColumn("h", word_hashes(F.col("w"))), "candidate-words")
    found = []
    for k, _ in classes:
        # the word hashes are a column: inside the gram's lambda they would be computed again for every position
        at = texts.select("doc_id", "text_hash", F.posexplode(grams(F.col("h"), k)).alias("pos", "fp"))
        found.append(at.join(checked(prints.where(F.col("k") == k)), "fp").select("doc_id", "text_hash", "item", (F.col("pos") - F.col("item_pos")).alias("offset")))
    diagonals = found[0]
    for x in found[1:]:
        diagonals = diagonals.unionByName(x)
    diagonals = diagonals.distinct()

    # 3: extension along each diagonal: "1" where the words are equal
    same = F.col("d.doc_id").eqNullSafe(F.col("x.doc_id")) & (F.col("d.text_hash") == F.col("x.text_hash"))
    # an item's words join once a diagonal
    pairs = diagonals.join(item_rows, "item").alias("d").join(texts.select("doc_id", "text_hash", "w").alias("x"), same)
    lead = F.greatest(F.lit(0), -F.col("offset"))  # item words before the document begins
    part = F.slice("w", F.greatest(F.lit(1), F.col("offset") + 1), F.size("item_words") - lead)
    equal = F.array_join(F.zip_with(part, F.slice("item_words", lead + 1, F.size("item_words")), lambda a, b: F.when(a == b, "1").otherwise("0")), "")
    equal = F.regexp_replace(equal, "null", "0")
    runs = pairs.select("d.doc_id", "d.text_hash", "item_id", F.greatest(F.lit(0), F.col("offset")).alias("first"), F.least(F.lit(span), F.size("item_words")).alias("need"), F.regexp_extract_all(equal, F.lit("0+|1+"), F.lit(0)).alias("runs"))
    mask = F.array_join(F.transform("runs", lambda r: F.when(r.startswith("1") & (F.length(r) >= F.col("need")), r).otherwise(F.repeat(F.lit("0"), F.length(r)))), "")
    hits = runs.select("doc_id", "text_hash", "item_id", "first", mask.alias("mask")).where(F.col("mask").contains("1"))
    hits = stored(hits, "hits")
    items_of = hits.groupBy("doc_id", "text_hash").agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    places = hits.select("doc_id", "text_hash", "first", F.posexplode(F.split("mask", "")).alias("i", "bit")).where("bit = '1'").select("doc_id", "text_hash", (F.col("first") + F.col("i")).alias("pos")).distinct()
    n_hit = places.groupBy("doc_id", "text_hash").agg(F.count("*").alias("n_hit"))

    safe = lambda a, b: F.col(f"{a}.doc_id").eqNullSafe(F.col(f"{b}.doc_id")) & F.col(f"{a}.text_hash").eqNullSafe(F.col(f"{b}.text_hash"))
    out = base.select("doc_id", "text_hash", "n_words").alias("b").join(items_of.alias("i"), safe("b", "i"), "left").join(n_hit.alias("n"), safe("b", "n"), "left")
    return out.select("b.doc_id", "b.text_hash", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def is_contaminated(n_hit: Column, n_words: Column) -> Column:
    """At least a word hit, and at least a twentieth of the words."""
    return (n_hit > 0) & (20 * n_hit >= n_words)
