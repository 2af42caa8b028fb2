"""Fingerprints of texts as homomorphic hashes of their paragraphs, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.common import text_or_empty
from riskloom.session import pin

LANES = 16  # lanes of 32 bits that tell whether paragraphs are equal
SIGNS = 60  # lanes of 32 bits that tell how alike they are
PIECE = 24  # code points of a piece, counted from its paragraph's start
DIGITS = 8  # hexadecimal digits of a lane
HALF = 1 << 31  # lanes count modulo 2^32 and are held as signed numbers
PAIR = (1 << 32) + 1  # the lowest bit of each of two 32-bit counters in a long


def _number(digits: Column) -> Column:
    return F.conv(digits, 16, 10).cast("long")


def _wrapped(lane: Column) -> Column:
    return (F.pmod(lane + HALF, F.lit(2 * HALF)) - HALF).cast("int")


def _elements(body: Column) -> Column:
    """A text's paragraphs (its lines), and each one's pieces: runs of ``PIECE`` code points.

    Pieces are counted from their paragraph's start, so what follows doesn't change them.
    """
    paragraphs = F.split(body, "\n", -1)
    pieces = F.flatten(F.transform(paragraphs, lambda p: F.regexp_extract_all(p, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))))
    whole = F.transform(paragraphs, lambda p: F.struct(F.lit(True).alias("whole"), p.alias("words")))
    return F.concat(whole, F.transform(pieces, lambda p: F.struct(F.lit(False).alias("whole"), p.alias("words"))))


def with_lanes(texts: DataFrame, keys: list[str], body: str = "body") -> DataFrame:
    """(keys, lanes): the 76 lanes of each text, the sum of the vectors hashed from its paragraphs.

    Lanes 0 to 15 of a paragraph's vector are two SHA-256 digests of it, told apart by what
    precedes it. In the other 60 each of the paragraph's pieces counts plus or minus one by
    a bit of its digest, so the expected product of two texts' lanes is the product of
    their counts of pieces. Sums are modulo 2^32: they don't depend on the order of
    paragraphs and change by one vector when a paragraph comes or goes.

    Paragraphs are exploded and summed lane by lane in generated code; ones are counted two
    lanes at a time, in the halves of a long. ``keys`` tell texts apart; rows that share
    them add up.
    """
    element = texts.select(*keys, F.explode(_elements(F.col(body))).alias("element"))
    whole, words = F.col("element.whole"), F.col("element.words")
    wide = F.concat(F.sha2(F.concat(F.lit("0|"), words), 256), F.sha2(F.concat(F.lit("1|"), words), 256))
    hashed = element.select(*keys, whole.alias("whole"), F.when(whole, wide).alias("wide"), F.when(~whole, _number(F.substring(F.md5(words), 1, SIGNS // 4))).alias("bits"))
    half = SIGNS // 2
    # Bit i + 30 goes to the high half, above bit i.
    spread = F.col("bits").bitwiseAND((1 << half) - 1) + F.shiftleft(F.shiftright("bits", half), 32)
    hashed = hashed.select(*keys, "wide", spread.alias("bits"))
    digests = [F.sum(_number(F.substring("wide", 1 + DIGITS * i, DIGITS))).alias(f"digest_{i}") for i in range(LANES)]
    ones = [F.sum(F.shiftright("bits", i).bitwiseAND(PAIR)).alias(f"ones_{i}") for i in range(half)]
    summed = hashed.groupBy(*keys).agg(*digests, *ones, F.count("bits").alias("pieces"))
    signs = [F.col(f"ones_{i}").bitwiseAND(2 * HALF - 1) for i in range(half)] + [F.shiftright(f"ones_{i}", 32) for i in range(half)]
    lanes = [F.col(f"digest_{i}") for i in range(LANES)] + [F.coalesce(s, F.lit(0)) * 2 - F.col("pieces") for s in signs]
    return summed.select(*keys, F.array(*[_wrapped(x) for x in lanes]).alias("lanes"))


def to_hex(lanes: Column) -> Column:
    """Lanes as one string of eight hexadecimal digits each: the fingerprint."""
    unsigned = lambda x: x.cast("long").bitwiseAND(2 * HALF - 1)
    return F.array_join(F.transform(lanes, lambda x: F.lpad(F.lower(F.hex(unsigned(x))), DIGITS, "0")), "")


def from_hex(fingerprint: Column) -> Column:
    starts = F.array(*[F.lit(1 + DIGITS * i) for i in range(LANES + SIGNS)])
    return F.transform(starts, lambda at: _wrapped(_number(F.substr(fingerprint, at, F.lit(DIGITS)))))


def inserted(of: Column, more: Column) -> Column:
    """The fingerprint ``of`` a text after paragraphs of fingerprint ``more`` have come in."""
    return to_hex(F.zip_with(from_hex(of), from_hex(more), lambda a, b: _wrapped(a.cast("long") + b)))


def deleted(of: Column, gone: Column) -> Column:
    """The fingerprint ``of`` a text after paragraphs of fingerprint ``gone`` have left."""
    return to_hex(F.zip_with(from_hex(of), from_hex(gone), lambda a, b: _wrapped(a.cast("long") - b)))


def likeness(a: Column, b: Column) -> Column:
    """From 0 to 1: one for equal lanes, else the cosine of the likeness lanes, never below 0.

    It estimates the cosine between the texts' counts of pieces with a standard error of
    about 1 / sqrt(60); lanes without pieces are like none but their equals.
    """
    lane = lambda lanes, i: F.element_at(lanes, LANES + 1 + i).cast("double")
    dot = lambda x, y: sum((lane(x, i) * lane(y, i) for i in range(1, SIGNS)), lane(x, 0) * lane(y, 0))
    norm = dot(a, a) * dot(b, b)
    cosine = F.greatest(F.lit(0.0), F.least(F.lit(1.0), dot(a, b) / F.sqrt(norm)))
    return F.when(a == b, 1.0).when(norm > 0, cosine).otherwise(0.0)


def document_key(doc_id: Column, text: Column) -> Column:
    """Rows of the same id and text are one document."""
    return F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("~")), F.lit("|"), text))


def successors(documents: DataFrame) -> DataFrame:
    """(key, next_key, next_chars, before_key, before_chars) of distinct (doc_id, key, n_chars).

    Documents ascend by doc_id (null first), those of one id by key, and the first follows
    the last. A range shuffle of narrow rows numbers them over all partitions, so neighbours
    meet by number and no task sees the whole order.
    """
    ordered = documents.repartitionByRange("doc_id", "key").sortWithinPartitions("doc_id", "key")
    numbered = pin(ordered.select("key", "n_chars", F.monotonically_increasing_id().alias("serial")), "document-order")
    part, row = F.shiftright("serial", 33), F.col("serial").bitwiseAND((1 << 33) - 1)
    numbered = numbered.select("key", "n_chars", part.alias("part"), row.alias("row"))
    # One row per partition.
    counts = numbered.groupBy("part").agg(F.count("*").alias("here"))
    everything = Window.partitionBy(F.lit(0))
    before = everything.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("part", F.coalesce(F.sum("here").over(before), F.lit(0)).alias("start"), F.sum("here").over(everything).alias("total"))
    placed = numbered.join(F.broadcast(starts), "part").select("key", "n_chars", (F.col("row") + F.col("start")).alias("pos"), "total")
    follows = placed.select(F.col("key").alias("next_key"), F.pmod(F.col("pos") - 1, F.col("total")).alias("pos"))
    return placed.join(follows, "pos").select("key", "n_chars", "next_key")


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and near_next.

    A document's edited text has its last floor(n_chars / 2) code points replaced by the
    first as many of the next document, or by all of them if it has fewer. Documents ascend
    by doc_id; those of one id by a digest; the first follows the last, and an only
    document follows itself.

    Only digests and counts are sorted. A text is shuffled once, by its document's digest.
    There it meets the number of code points that the document before it takes, and only
    those travel on to that document; all lanes are summed where the texts lie.

    A null text reads as an empty one, which has one empty paragraph; a null id comes
    first; repeated rows are one document and keep their rows; an empty table gives an
    empty one; further columns are ignored.
    """
    texts = docs.select("doc_id", text_or_empty().alias("text"))
    texts = texts.select("doc_id", "text", document_key(F.col("doc_id"), F.col("text")).alias("key"))
    rows = pin(texts.select("doc_id", "key", F.length("text").cast("long").alias("n_chars")), "documents-by-key")
    order = pin(successors(rows.dropDuplicates(["key"])), "document-next")
    once = texts.select("key", "text").repartition("key").groupBy("key").agg(F.first("text").alias("text"))
    takes = order.select(F.col("next_key").alias("key"), F.col("key").alias("taker"), F.floor(F.col("n_chars") / 2).cast("int").alias("taken"))
    heads = once.join(takes, "key").select(F.col("taker").alias("key"), F.expr("left(text, taken)").alias("head"))
    stays = F.expr("left(text, length(text) - CAST(floor(length(text) / 2) AS INT))")
    both = once.join(heads, "key").select("key", "text", F.concat(stays, "head").alias("edited"))
    own = F.struct(F.lit(None).cast("string").alias("sha256"), F.col("text").alias("body"))
    other = F.struct(F.sha2("edited", 256).alias("sha256"), F.col("edited").alias("body"))
    bodies = both.select("key", F.inline(F.array(own, other)))
    lanes = pin(with_lanes(bodies, ["key", "sha256"]), "fingerprints")
    of_text = lanes.filter("sha256 IS NULL").select("key", F.col("lanes").alias("own_lanes"))
    of_edited = lanes.filter("sha256 IS NOT NULL").select("key", F.col("sha256").alias("edited_sha256"), F.col("lanes").alias("edited_lanes"))
    follower = order.select("key", "next_key").join(of_text.toDF("next_key", "next_lanes"), "next_key").drop("next_key")
    joined = rows.join(of_text, "key").join(of_edited, "key").join(follower, "key")
    return joined.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        to_hex(F.col("own_lanes")).alias("fingerprint"),
        to_hex(F.col("edited_lanes")).alias("edited_fingerprint"),
        likeness(F.col("own_lanes"), F.col("edited_lanes")).alias("near_edited"),
        likeness(F.col("own_lanes"), F.col("next_lanes")).alias("near_next"),
    )


FINGERPRINT_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS text FROM documents),
u AS (SELECT DISTINCT doc_id, text, md5(coalesce(doc_id::VARCHAR, '~') || '|' || text) AS key FROM d),
o AS (SELECT *, length(text) AS n, coalesce(lead(text) OVER w, first_value(text) OVER w) AS next FROM u WINDOW w AS (ORDER BY doc_id NULLS FIRST, key)),
e AS (SELECT doc_id, text, next, substr(text, 1, n - n // 2) || substr(next, 1, n // 2) AS edited FROM o),
b AS (SELECT DISTINCT unnest([text, edited, next]) AS body FROM e),
p AS (SELECT body, unnest(string_split(body, chr(10))) AS p FROM b),
q AS (SELECT body, md5(unnest(regexp_extract_all(p, '(?s).{1,24}'))) AS h FROM p),
g AS (SELECT body, ('0x' || substr(h, 1, 15))::BIGINT AS bits FROM q),
s AS (SELECT body, 16 + i AS lane, sum(CASE WHEN bits >> i & 1 = 1 THEN 1 ELSE -1 END)::BIGINT AS v FROM g, (SELECT unnest(range(60)) AS i) GROUP BY ALL),
a AS (SELECT body, i AS lane, sum(('0x' || substr(sha256('0|' || p) || sha256('1|' || p), 1 + 8 * i, 8))::BIGINT)::HUGEINT % 4294967296 AS v
      FROM p, (SELECT unnest(range(16)) AS i) GROUP BY ALL),
f AS (SELECT x.body, x.i AS lane, coalesce(a.v, s.v, 0)::BIGINT AS v FROM (SELECT body, unnest(range(76)) AS i FROM b) x
      LEFT JOIN a ON a.body = x.body AND a.lane = x.i LEFT JOIN s ON s.body = x.body AND s.lane = x.i),
h AS (SELECT body, string_agg(printf('%08x', (v + 4294967296) % 4294967296), '' ORDER BY lane) AS fp,
             list(v::DOUBLE ORDER BY lane) FILTER (lane >= 16) AS signs FROM f GROUP BY body)
SELECT d.doc_id, length(d.text) AS n_chars, sha256(e.edited) AS edited_sha256, x.fp AS fingerprint, y.fp AS edited_fingerprint,
       CASE WHEN x.fp = y.fp THEN 1.0::DOUBLE WHEN list_dot_product(x.signs, x.signs) * list_dot_product(y.signs, y.signs) > 0
            THEN greatest(0, least(1, list_dot_product(x.signs, y.signs) / sqrt(list_dot_product(x.signs, x.signs) * list_dot_product(y.signs, y.signs)))) ELSE 0 END AS near_edited,
       CASE WHEN x.fp = z.fp THEN 1.0::DOUBLE WHEN list_dot_product(x.signs, x.signs) * list_dot_product(z.signs, z.signs) > 0
            THEN greatest(0, least(1, list_dot_product(x.signs, z.signs) / sqrt(list_dot_product(x.signs, x.signs) * list_dot_product(z.signs, z.signs)))) ELSE 0 END AS near_next
FROM d JOIN e ON e.doc_id IS NOT DISTINCT FROM d.doc_id AND e.text = d.text
     JOIN h x ON x.body = d.text JOIN h y ON y.body = e.edited JOIN h z ON z.body = e.next
"""
