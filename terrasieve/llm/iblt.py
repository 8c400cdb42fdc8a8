"""Document fingerprints by invertible Bloom lookup tables of paragraph digests. Columns and SQL functions only.

A text is cut into paragraphs, and its distinct paragraphs' 64-bit digests are the set that a sketch holds. A sketch has
three subtables of a power of two cells; a digest lies in one cell of each. A cell has a count, the exclusive or of its
digests, and that of their check hashes. Two sketches of one size subtract cell by cell: what both hold cancels, and
peeling takes the differing digests out of cells that hold one alone, which leaves others alone in theirs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import Stored, stored

PARAGRAPH = r"\n|(?<=[aeiou])\."  # a paragraph ends with a line, or at a full stop after a vowel: some three sentences
TABLES = 3
LEAST = 4  # a subtable has 2 ** LEAST cells at least, and two for each digest
LARGER = 3  # a retry has 2 ** LARGER times the cells
PHASES = (0, 1, 2, 0, 1)  # the subtables that are peeled, in turn
CHECK_SEED = 7
CELL_BITS, SIZE_BITS = 40, 8  # of a slot: cell, size of a subtable as a power of two, then pair and subtable
BLOCKS, TASKS = 8, 4  # blocks of neighbouring documents, and tasks that compare them, for each shuffle partition
SPREAD = 50  # copies for each block below which equal rows stay in one


def digests(text: Column) -> Column:
    """The distinct digests of a text's paragraphs, trimmed, without empty ones."""
    pieces = F.filter(F.transform(F.split(text, PARAGRAPH), lambda x: F.trim(x)), lambda x: x != "")
    return F.array_distinct(F.transform(pieces, lambda x: F.xxhash64(x)))


def check(key: Column) -> Column:
    return F.xxhash64(key, F.lit(CHECK_SEED))


def power(found: Column) -> Column:
    """log2 of the cells of a subtable for these digests: two cells a digest or more."""
    return F.greatest(F.length(F.bin(F.greatest(2 * F.size(found) - 1, F.lit(1)).cast("long"))), F.lit(LEAST)).cast("long")


def cell(digest: Column, table: Column, size: Column) -> Column:
    return F.xxhash64(digest, table).bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), size.cast("int")) - 1)


def fingerprint(found: Column) -> Column:
    """A sketch as text: base64 of its size (a byte, as a power of two), then of every filled cell in order its subtable (a byte), number (four), count (two), digests and checks (eight each)."""
    size = power(found)
    placed = lambda d: F.array(*[F.struct(F.lit(t).alias("table"), cell(d, F.lit(t), size).alias("cell"), d.alias("key")) for t in range(TABLES)])
    entries = F.array_sort(F.flatten(F.transform(found, placed)))
    zero = F.lit(0).cast("long")
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("table"), zero.alias("cell"), F.lit(0).alias("n"), zero.alias("key"), zero.alias("mark"))
    wide = lambda x, digits: F.lpad(F.hex(x), digits, "0")
    flushed = lambda a: F.when(a["n"] == 0, "").otherwise(F.concat(a["out"], wide(a["table"], 2), wide(a["cell"], 8), wide(a["n"], 4), wide(a["key"], 16), wide(a["mark"], 16)))

    def merged(a: Column, x: Column) -> Column:
        same = (a["n"] > 0) & (a["table"] == x["table"]) & (a["cell"] == x["cell"])
        kept = lambda value, other: F.when(same, value).otherwise(other)
        return F.struct(
            kept(a["out"], flushed(a)).alias("out"), x["table"].alias("table"), x["cell"].alias("cell"), kept(a["n"] + 1, F.lit(1)).alias("n"),
            kept(a["key"].bitwiseXOR(x["key"]), x["key"]).alias("key"), kept(a["mark"].bitwiseXOR(check(x["key"])), check(x["key"])).alias("mark"),
        )

    return F.base64(F.unhex(F.concat(wide(size, 2), F.aggregate(entries, start, merged, flushed))))


def _ordered(docs: DataFrame) -> DataFrame:
    """(flag, id, h, tie, doc_id, text): what rows are ordered by, null ids first, rows of one id by a hash of their texts."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(F.col("doc_id").isNotNull().cast("int").alias("flag"), F.coalesce("doc_id", F.lit(0)).cast("long").alias("id"), F.xxhash64(text).alias("h"), F.monotonically_increasing_id().alias("tie"), "doc_id", text.alias("text"))


def with_next(docs: DataFrame) -> DataFrame:
    """(block, place, doc_id, text, a, next_text, x): each row with the next by ascending doc_id, after the last the first; a and x are digests.

    Blocks of neighbouring rows hold about as many rows each, whatever the ids are: bounds come from a range partitioning
    of narrow rows, of which the driver gets one row a block. Whole texts are shuffled once, by block, and the first row
    of a block is sent to the block before it as well. Equal rows that fill several blocks are spread over these; which
    of them goes where makes no difference.
    """
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = _ordered(docs)
    narrow = rows.select("flag", "id", "h", "tie").repartitionByRange(BLOCKS * partitions, "flag", "id", "h", "tie")
    parts = narrow.groupBy(F.spark_partition_id().alias("part")).agg(F.min(F.struct("flag", "id", "h")).alias("low"), F.count("*").alias("n")).collect()
    runs: list[list] = []  # [low, blocks that begin with it, rows in all of these but the last]
    for part in sorted(parts, key=lambda r: (tuple(r["low"]), r["part"])):
        low = tuple(part["low"])
        if runs and runs[-1][0] == low:
            runs[-1][1].append(runs[-1][1][-1] + 1)
            runs[-1][2] += last
        else:
            runs.append([low, [runs[-1][1][-1] + 1 if runs else 0], 0])
        last = part["n"]
    if not runs:
        return rows.select(F.lit(0).alias("block"), F.lit(0).alias("place"), "doc_id", "text", digests(F.col("text")).alias("a"), F.col("text").alias("next_text"), digests(F.col("text")).alias("x"))
    for run in runs:
        if run[2] < SPREAD * len(run[1]):
            run[1] = run[1][-1:]
    active = [block for _, blocks, _ in runs for block in blocks]
    before = dict(zip(active, active[-1:] + active[:-1]))
    kind = "struct<flag:int,id:bigint,h:bigint>"
    table = spark.createDataFrame([(*low, blocks, [before[b] for b in blocks]) for low, blocks, _ in runs], "flag int, id long, h long, blocks array<int>, before array<int>")  # a row a block at most
    lows = F.from_json(F.lit("[" + ",".join(f'{{"flag":{f},"id":{i},"h":{h}}}' for (f, i, h), _, _ in runs) + "]"), f"array<{kind}>")
    spans = F.from_json(F.lit("[" + ",".join(f"[{blocks[0]},{len(blocks)}]" for _, blocks, _ in runs) + "]"), "array<array<int>>")
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(len(runs).bit_length()))])
    key = F.struct("flag", "id", "h")
    run_of = F.aggregate(steps, F.lit(0), lambda at, step: F.when((at + step < len(runs)) & (F.get(lows, at + step) <= key), at + step).otherwise(at))
    placed = rows.withColumn("run", run_of).withColumn("span", F.get(spans, F.col("run")))
    at = F.when(F.get(lows, F.col("run")) == key, F.pmod(F.xxhash64("tie"), F.get("span", F.lit(1)).cast("long")).cast("int")).otherwise(F.get("span", F.lit(1)) - 1)
    columns = ("flag", "id", "h", "doc_id", "text")
    placed = placed.select((F.get("span", F.lit(0)) + at).alias("block"), F.lit(0).alias("extra"), *columns)
    heads = rows.join(F.broadcast(table), ["flag", "id", "h"]).groupBy("flag", "id", "h", "before").agg(F.first("doc_id").alias("doc_id"), F.first("text").alias("text"))
    sent = placed.unionByName(heads.select(F.explode("before").alias("block"), F.lit(1).alias("extra"), *columns))
    order = Window.partitionBy("block").orderBy("extra", "flag", "id", "h")
    sent = sent.withColumn("a", digests(F.col("text"))).repartition(TASKS * partitions, "block")
    done = sent.withColumns({"next_text": F.lead("text").over(order), "x": F.lead("a").over(order), "place": F.row_number().over(order)})
    return done.filter("extra = 0").select("block", "place", "doc_id", "text", "a", "next_text", "x")


def edits(rows: DataFrame) -> DataFrame:
    """(block, place, about) from rows of `with_next`; about: doc_id, n_chars, edited_sha256, and the digests a, e and x of the text, the edited text and the next text."""
    n = F.length("text")
    half = F.expr("length(text) div 2")
    edited = F.concat(F.col("text").substr(F.lit(1), n - half), F.col("next_text").substr(F.lit(1), half))
    made = rows.select("block", "place", "doc_id", n.cast("long").alias("n_chars"), edited.alias("edited"), "a", "x")
    return made.select("block", "place", F.struct("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "a", digests(F.col("edited")).alias("e"), "x").alias("about"))


def compare(rows: DataFrame, larger: int = 0) -> DataFrame:
    """(block, place, about, d0, d1, left0, left1) of rows (block, place, about): how many digests of the text differ from the edited text's and from the next's, as far as peeled, and the cells left.

    Both texts of a pair are sketched at the larger one's size (times 2 ** larger), and the sketches are summed with
    opposite signs: the difference of the two fingerprints, of which the smaller is spread to the larger's size. A round
    of peeling goes over one subtable. A cell that holds one digest alone gives it up: it is counted and taken out of its
    cells in the other subtables. All of it is sums a row and cell, so if the rows come dealt by block, nothing is
    shuffled.
    """
    sides = ((0, "a", 1), (0, "e", -1), (1, "a", 1), (1, "x", -1))
    size = {0: F.greatest(power(F.col("about.a")), power(F.col("about.e"))) + larger, 1: F.greatest(power(F.col("about.a")), power(F.col("about.x"))) + larger}
    none = F.lit(None).cast(rows.schema["about"].dataType)
    item = lambda pair, sign, d, about=none: F.struct(F.lit(pair).alias("pair"), F.lit(sign).cast("long").alias("n"), d.alias("key"), about.alias("about"))
    of = lambda pair, name, sign: F.transform(F.col(f"about.{name}"), lambda d: item(pair, sign, d))
    items = F.concat(F.array(item(-1, 0, F.lit(0).cast("long"), F.col("about"))), *[of(*side) for side in sides])
    tables = F.when(F.col("i.pair") < 0, F.array(F.lit(0))).otherwise(F.array(*map(F.lit, range(TABLES))))
    dealt = rows.select("block", "place", size[0].alias("s0"), size[1].alias("s1"), F.explode(items).alias("i"))
    dealt = dealt.select("block", "place", "i.pair", "i.n", "i.key", "i.about", F.when(F.col("i.pair") == 0, F.col("s0")).otherwise(F.col("s1")).alias("size"), F.explode(tables).alias("table"))
    left = lambda x, bits: F.call_function("shiftleft", x.cast("long"), F.lit(bits))
    slot = lambda pair, table, size, digest: left(pair * TABLES + table, CELL_BITS + SIZE_BITS) + left(size, CELL_BITS) + cell(digest, table, size)
    first = F.when(F.col("pair") < 0, F.lit(-1).cast("long")).otherwise(slot(F.col("pair"), F.col("table"), F.col("size"), F.col("key")))
    mark = F.when(F.col("pair") < 0, F.lit(0).cast("long")).otherwise(check(F.col("key")))
    cells = dealt.select("block", "place", first.alias("slot"), "n", "key", mark.alias("mark"), "about")

    def summed(cells: DataFrame) -> DataFrame:
        done = cells.groupBy("block", "place", "slot", "about").agg(F.sum("n").alias("n"), F.bit_xor("key").alias("key"), F.bit_xor("mark").alias("mark"))
        return done.filter("slot < 0 OR n <> 0 OR key <> 0 OR mark <> 0")

    cells = summed(cells)
    for table in PHASES:
        place = F.shiftright("slot", CELL_BITS + SIZE_BITS)
        pair, own, size = F.floor(place / TABLES), place % TABLES, F.shiftright("slot", CELL_BITS).bitwiseAND(F.lit((1 << SIZE_BITS) - 1))
        key = F.col("key")
        alone = (F.col("slot") >= 0) & (own == table) & (F.abs("n") == 1) & (check(key) == F.col("mark")) & (slot(pair, own.cast("int"), size, key) == F.col("slot"))
        entry = lambda slot, n, key, mark, about=none: F.struct(slot.alias("slot"), n.alias("n"), key.alias("key"), mark.alias("mark"), about.alias("about"))
        zero = F.lit(0).cast("long")
        told = [entry(-2 - pair, F.lit(1).cast("long"), zero, zero)]  # counted as found
        told += [entry(slot(pair, F.lit(t), size, key), -F.col("n"), key, F.col("mark")) for t in range(TABLES) if t != table]
        kept = F.array(entry(F.col("slot"), F.col("n"), key, F.col("mark"), F.col("about")))
        cells = summed(cells.select("block", "place", F.explode(F.when(alone, F.array(*told)).otherwise(kept)).alias("c")).select("block", "place", "c.*"))
    count = lambda when, value: F.coalesce(F.sum(F.when(when, value)), F.lit(0).cast("long"))
    beyond = 1 << (CELL_BITS + SIZE_BITS)
    return cells.groupBy("block", "place").agg(
        F.first("about", ignorenulls=True).alias("about"), count(F.col("slot") == -2, F.col("n")).alias("d0"), count(F.col("slot") == -3, F.col("n")).alias("d1"),
        count((F.col("slot") >= 0) & (F.col("slot") < TABLES * beyond), F.lit(1)).alias("left0"), count(F.col("slot") >= TABLES * beyond, F.lit(1)).alias("left1"),
    )


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) for every row.

    The edited text is the text with its last floor(n_chars / 2) code points replaced by the first as many of the next
    row's text. Fingerprints are sketches sized by the text's paragraphs, so that they can be subtracted from one another
    and peeled; likeness is the Jaccard index of the paragraphs, from the two sets' sizes and the digests that peeling
    finds to differ. Two empty sets are alike. Where peeling stops early, sketches of eight times the cells are compared;
    where that stops too, the digests themselves are.

    Null texts count as empty; a lone row is its own next; rows of one id follow one another by a hash of their texts, and
    repeated rows each get a result. Very long texts have larger sketches. Other columns are not read; an empty table
    gives an empty result.
    """
    made = Stored(compare(edits(with_next(docs))), "iblt").df
    whole = made.filter("left0 = 0 AND left1 = 0")
    stopped = made.filter("left0 <> 0 OR left1 <> 0").select("block", "place", "about")
    again = stored(compare(stopped, LARGER), "iblt-larger")
    apart = lambda left, d, a, b: F.when(F.col(left) == 0, F.col(d)).otherwise((F.size(F.array_except(a, b)) + F.size(F.array_except(b, a))).cast("long"))
    again = again.withColumns({"d0": apart("left0", "d0", F.col("about.a"), F.col("about.e")), "d1": apart("left1", "d1", F.col("about.a"), F.col("about.x"))})
    both = whole.unionByName(again).select("about.*", "d0", "d1")
    sizes = lambda other: F.size("a") + F.size(other)
    like = lambda other, d: F.when(sizes(other) == 0, 1.0).otherwise((sizes(other) - F.col(d)) / (sizes(other) + F.col(d)))
    return both.select("doc_id", "n_chars", "edited_sha256", fingerprint(F.col("a")).alias("fingerprint"), fingerprint(F.col("e")).alias("edited_fingerprint"), like("e", "d0").alias("near_edited"), like("x", "d1").alias("near_next"))
