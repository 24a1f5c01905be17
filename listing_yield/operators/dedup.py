"""Newest-wins / first-seen deduplication (W1-W3), skew-safe.

A ``row_number()`` window would send every row of a key to one task; a key
holding a third of all rows (NULL url, say) would then sit in one task.  Here
"keep the newest row per key" is an aggregation instead:
``max(struct(order, row_id, carried...))`` per key, which Spark combines
map-side (partial aggregate) before the shuffle, so a hot key shrinks to one
row per input partition.  Only a narrow projection goes through the
aggregations; the table is joined back once, on the row's number (``_copia``) where it has
one, else on ``row_id``.

Repeated rows (the same ``row_id`` more than once) count as copies of one row: one of
them survives, of numbered rows the one with the smallest number.  ``with_row_id`` gives rows without an id one made from their content, so
identical rows share it.

Order: newest = ``order DESC NULLS LAST, row_id DESC``; oldest (first seen) =
``order ASC NULLS LAST, row_id ASC``.  ``row_id`` makes the order total, so
the result does not depend on partitioning (pandas' unstable sort did).
NULL keys form one group, like pandas' ``duplicated``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import rules

ROW_ID = "row_id"


def with_row_id(df: DataFrame, row_id: str = ROW_ID) -> DataFrame:
    """``df`` with a ``row_id``: its own, or a digest of the whole row (equal for identical rows)."""
    if row_id in df.columns:
        return df
    return df.withColumn(row_id, F.sha2(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]),
                                                  {"ignoreNullFields": "false"}), 256))


def survivors(df: DataFrame, keys: Sequence[str], order: str = "fecha_scraping",
              row_id: str = ROW_ID, carry: Sequence[str] | None = None,
              newest: bool = True) -> DataFrame:
    """One row per distinct ``keys``: the newest (or oldest) by ``order`` then ``row_id``.

    Returns the carried columns (default: every column of ``df``). The keys themselves go through the shuffle once.
    """
    carry = list(df.columns if carry is None else carry)
    fields = [c for c in carry if c not in (order, row_id, *keys)]
    if newest:
        packed = F.struct(F.col(order).alias("_o"), F.col(row_id).alias("_id"), *[F.col(c) for c in fields])
        best = F.max(packed)
    else:
        packed = F.struct(F.col(order).isNull().alias("_n"), F.col(order).alias("_o"),
                          F.col(row_id).alias("_id"), *[F.col(c) for c in fields])
        best = F.min(packed)
    out = df.groupBy(*keys).agg(best.alias("_b"))
    out = out.select("_b.*", *[c for c in carry if c in keys and c not in (order, row_id)])
    return out.withColumnsRenamed({"_o": order, "_id": row_id}).select(*carry)


COPY = "_copia"  # a number of its own for each row, copies of one row included

DEDUP_KEY_ADDRESS = ["direccion", "sup_total_m2", "precio_valor", "operacion"]


LEVEL = "_lvl"


def cascade_levels(alive_rows: DataFrame, order: str = "fecha_scraping", row_id: str = ROW_ID) -> DataFrame:
    """W1 on a narrow projection: (row number or else row_id, level) where level = last dedup level survived.

    Level 1 survives the url check, 2 the id check, 3 the same-property check.
    Each level only sees the survivors of the previous one, and carries what the
    levels after it compare.  Both readers of a survivor set read the same shuffle.
    """
    if COPY in alive_rows.columns:
        ident, own = "_menos", [(-F.col(COPY)).alias("_menos")]  # the greatest row of a tie has the smallest number
    else:
        ident, own = row_id, []
    carry = [order, row_id, *(["_menos"] if own else [])]
    narrow = alive_rows.select(row_id, order, *own, "url", "id_aviso", *DEDUP_KEY_ADDRESS)
    s1 = survivors(narrow, ["url"], order, row_id, carry=[*carry, "id_aviso", *DEDUP_KEY_ADDRESS])
    s2 = survivors(s1, ["id_aviso"], order, row_id, carry=[*carry, *DEDUP_KEY_ADDRESS])
    s3 = survivors(s2.filter(F.col("direccion").isNotNull()), DEDUP_KEY_ADDRESS, order, row_id, carry=carry)
    at = lambda n: F.lit(n).cast("tinyint").alias(LEVEL)
    levels = (s1.select(ident, at(1))
              .unionByName(s2.select(ident, F.when(F.col("direccion").isNull(), 3).otherwise(2).cast("tinyint").alias(LEVEL)))
              .unionByName(s3.select(ident, at(3))))
    levels = levels.groupBy(ident).agg(F.max(LEVEL).alias(LEVEL))
    return levels.select((-F.col(ident)).alias(COPY), LEVEL) if own else levels


def dedup_cascade(tagged: DataFrame, order: str = "fecha_scraping", row_id: str = ROW_ID) -> DataFrame:
    """Tag duplicates among the alive rows: duplicado_url, duplicado_id, duplicado_mismo_inmueble."""
    levels = cascade_levels(tagged.filter(rules.alive()), order, row_id)
    return tag_levels(tagged.join(levels, COPY if COPY in tagged.columns else row_id, "left"))


# The rows that may meet another one. Keys' numbers of 42 bits are counted; those seen twice set a bit of a map of 2^28
# bits (32 MB, whatever the table's size). A number or bit met by chance only sends a row through the cascade in vain.
MAP_BITS, MAP_WORDS = 28, 512  # 512 longs in each of at most 8,192 rows of the map
KEYS_PER_TASK = 1_000_000
MEETS = ["_en_url", "_en_id", "_en_dir"]


def _key_numbers() -> list:
    """A number for each level's key; null where the key is null (such rows are one group, or none without address)."""
    number = lambda n, *cols: F.shiftrightunsigned(F.xxhash64(F.lit(n), *cols), 22)
    return [F.when(F.col("url").isNotNull(), number(1, "url")), F.when(F.col("id_aviso").isNotNull(), number(2, "id_aviso")),
            F.when(F.col("direccion").isNotNull(), number(3, *DEDUP_KEY_ADDRESS))]


def repeated_keys(alive_rows: DataFrame, n_rows: int) -> DataFrame:
    """The map's rows (bucket, words) of the keys that more than one of about ``n_rows`` rows has, at any level.

    Rows go to the counting tasks as bare numbers, a million to a task, so that no task sorts or keeps whole rows."""
    numbers = alive_rows.select(F.explode(F.array_compact(F.array(*_key_numbers()))).alias("h"))
    twice = (numbers.repartition(n_rows * 3 // KEYS_PER_TASK + 1, "h").groupBy("h").agg(F.count(F.lit(1)).alias("n"))
             .filter("n > 1").select((F.col("h") % (1 << MAP_BITS)).alias("bit")))
    words = twice.groupBy(F.shiftright("bit", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(bit % 64 as int))")).alias("bits"))
    return _map_rows(words)


def _map_rows(words: DataFrame) -> DataFrame:
    """The words (word, bits) of a map put together as rows (bucket, words)."""
    rows = words.groupBy(F.shiftright("word", 9).alias("bucket")).agg(F.array_sort(F.collect_list(
        F.struct((F.col("word") % MAP_WORDS).cast("int").alias("at"), "bits"))).alias("a"))
    gap = "x.at - coalesce(get(a, j - 1).at, -1) - 1"  # words of no bit between two others
    return rows.select("bucket", F.expr(
        f"flatten(transform(a, (x, j) -> concat(array_repeat(0L, {gap}), array(x.bits))))").alias("words"))


def mark_repeated(rows: DataFrame, repeated: DataFrame) -> DataFrame:
    """``rows`` with a flag for each level: false where no other alive row can have this row's key. A row without an
    address meets none at the last level; null urls and ids are one group."""
    rows = rows.withColumns({f"_h{i}": h for i, h in enumerate(_key_numbers())})
    for i, name in enumerate(MEETS):
        h = F.col(f"_h{i}") % (1 << MAP_BITS)
        row = F.broadcast(repeated.select(F.col("bucket").alias("_b"), F.col("words").alias("_w")))
        rows = rows.join(row, F.shiftright(h, 15) == F.col("_b"), "left")
        word = F.get("_w", (F.shiftright(h, 6) % MAP_WORDS).cast("int"))
        hit = F.coalesce(F.call_function("getbit", word, (h % 64).cast("int")) == 1, F.lit(False))
        rows = rows.withColumn(name, hit if i == 2 else F.col(f"_h{i}").isNull() | hit).drop("_b", "_w")
    return rows.drop(*[f"_h{i}" for i in range(len(MEETS))])


def only_meeting(marked: DataFrame) -> DataFrame:
    """The alive rows that the cascade must look at, without the address of those that no other row shares."""
    rows = marked.filter(rules.alive() & (F.col(MEETS[0]) | F.col(MEETS[1]) | F.col(MEETS[2])))
    return rows.withColumns({c: F.when(F.col(MEETS[2]), F.col(c)) for c in DEDUP_KEY_ADDRESS}).drop(*MEETS)


VERDICT_ROWS = 1 << 28  # of up to so many rows the verdicts, 64 MB, are broadcast; of more, rows and verdicts are shuffled
_SHIFT = f"cast({COPY} % 32 * 2 as int)"


def verdicts(marked: DataFrame, levels: DataFrame) -> DataFrame:
    """A map's rows (bucket, words) with two bits for each row number: 3 less the level that the row survived. Rows that
    survive all are left out, as are those that the cascade need not look at. Only rows that meet another's url can fail
    to be among ``levels``."""
    first = marked.filter(rules.alive() & F.col(MEETS[0])).select(COPY, F.lit(0).cast("tinyint").alias(LEVEL))
    dropped = first.unionByName(levels).groupBy(COPY).agg(F.max(LEVEL).alias(LEVEL)).filter(F.col(LEVEL) < 3)
    return _map_rows(dropped.groupBy(F.shiftright(COPY, 5).alias("word")).agg(
        F.bit_or(F.expr(f"shiftleft(cast(3 - {LEVEL} as bigint), {_SHIFT})")).alias("bits")))


def with_levels(rows: DataFrame, verdict_rows: DataFrame, n_rows: int) -> DataFrame:
    """``rows``, about ``n_rows``, with the level that their number survived by ``verdicts`` (NULL: not the first). The rows
    stay where they are."""
    side = verdict_rows.select(F.col("bucket").alias("_b"), F.col("words").alias("_w"))
    rows = rows.join(F.broadcast(side) if n_rows <= VERDICT_ROWS else side, F.shiftright(COPY, 14) == F.col("_b"), "left")
    word = f"coalesce(get(_w, cast(shiftright({COPY}, 5) % {MAP_WORDS} as int)), 0L)"
    code = F.expr(f"cast(shiftrightunsigned({word}, {_SHIFT}) & 3 as tinyint)")
    return rows.withColumn(LEVEL, F.when(code < 3, (F.lit(3) - code).cast("tinyint"))).drop("_b", "_w")


def tag_levels(joined: DataFrame) -> DataFrame:
    """The reasons of the alive rows by the level that they survived."""
    lvl = F.col(LEVEL)
    reason = (F.when(lvl.isNull(), F.lit("duplicado_url"))
              .when(lvl == 1, F.lit("duplicado_id"))
              .when(lvl == 2, F.lit("duplicado_mismo_inmueble")))
    return joined.withColumn(rules.REASON, F.when(rules.alive(), reason).otherwise(F.col(rules.REASON))).drop(LEVEL)


def keep_survivors(df: DataFrame, survivor_ids: DataFrame, row_id: str = ROW_ID) -> DataFrame:
    """The surviving rows, each once: copies of a row share its ``row_id``.  The copies are dropped where the join
    has already put them together, so this adds no shuffle."""
    return df.join(survivor_ids.select(row_id), row_id, "left_semi").dropDuplicates([row_id])


def snapshot_merge(df: DataFrame, order: str = "fecha_scraping", row_id: str = ROW_ID) -> DataFrame:
    """Newest per (portal, id_aviso), then newest per url, on the merged snapshots."""
    df = with_row_id(df, row_id)
    narrow = df.select(row_id, order, "portal", "id_aviso", "url")
    s1 = survivors(narrow, ["portal", "id_aviso"], order, row_id)
    s2 = survivors(s1, ["url"], order, row_id, carry=[row_id])
    return keep_survivors(df, s2, row_id)


def first_seen(df: DataFrame, order: str = "fecha_scraping", row_id: str = ROW_ID) -> DataFrame:
    """First row per key (url, else id) in arrival order; rows with neither key are dropped."""
    df = with_row_id(df, row_id)
    key = F.coalesce(F.col("url"), F.col("id_aviso"))
    narrow = df.select(row_id, order, key.alias("_key")).filter(F.col("_key").isNotNull())
    s = survivors(narrow, ["_key"], order, row_id, carry=[row_id], newest=False)
    return keep_survivors(df, s, row_id)
