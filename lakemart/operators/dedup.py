"""Distinct keys and one row per key (A2-A4)."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from lakemart.operators import places
from lakemart.operators.places import ROW_PLACE

_RANK = "_keep_rank"
ROW_HASH = "_row_hash"
#: Repeated keys that are broadcast at most; with more of them, rows and winners meet by a shuffle.
REPEATED_KEYS = 4_000_000


def distinct_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct projection (A2); equal rows meet before the shuffle."""
    return df.select(*keys).distinct()


def keep_one(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column] = ()) -> DataFrame:
    """First row per key in the given order; the whole row breaks ties, so the choice is reproducible (A3).

    Spark turns ``row_number() = 1`` into a group limit on both sides of the
    shuffle: each map task sends at most one row per key, so a key that holds
    a large part of the table does not gather in one task.
    """
    ties = [
        F.to_json(f.name) if isinstance(f.dataType, MapType) else F.col(f.name)
        for f in df.schema.fields
        if f.name not in keys
    ]
    order = [*order_by, *[t.asc_nulls_last() for t in ties]]
    if not order:
        return df.distinct()
    ranked = df.withColumn(_RANK, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col(_RANK) == 1).drop(_RANK)


def row_hash(df: DataFrame) -> Column:
    """64-bit hash of every column of a row."""
    return F.xxhash64(*[F.to_json(f.name) if isinstance(f.dataType, MapType) else F.col(f"`{f.name}`") for f in df.schema.fields])


def _hashed(df: DataFrame, rows: DataFrame) -> DataFrame:
    """``rows``, which have the columns of ``df`` and maybe more, with ``ROW_HASH``."""
    return rows if ROW_HASH in df.columns else rows.withColumn(ROW_HASH, row_hash(df))


def _chosen(side: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, Column]:
    """The side with its key and hash columns renamed, and the condition that a row has its key."""
    same = reduce(and_, [F.col(f"`{c}`").eqNullSafe(F.col(f"_chosen_{c}")) for c in keys])
    return side.withColumnsRenamed({c: f"_chosen_{c}" for c in (*keys, ROW_HASH)}), same


def _times(newest: str | None, path: str | None) -> list[str]:
    return [c for c in (newest, path) if c is not None]


def _order(newest: str | None, path: str | None) -> list[Column]:
    newest_first = [] if newest is None else [F.col(newest).desc_nulls_last()]
    return newest_first if path is None else [*newest_first, F.col(path).asc_nulls_last()]


def _first(narrow: DataFrame, keys: Sequence[str], newest: str | None, path: str | None, columns: Sequence[str]) -> DataFrame:
    """The ``columns`` of a first row per key by time and path, and whether another has the same time and path (``_tied``)."""
    order = _order(newest, path) or [F.col(f"`{keys[0]}`")]
    ranked = narrow.withColumn(_RANK, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col(_RANK) <= 2)

    def of(place: int, c: str) -> Column:
        return F.max(F.when(F.col(_RANK) == place, F.col(c)))

    same = [of(1, c).eqNullSafe(of(2, c)) for c in _times(newest, path)]
    return ranked.groupBy(*keys).agg(*[of(1, c).alias(c) for c in columns if c not in keys], reduce(and_, same, F.max(_RANK) == 2).alias("_tied"))


def _winners(narrow: DataFrame, keys: Sequence[str], newest: str | None, path: str | None) -> DataFrame:
    """Key and hash of the newest narrow row per key, and whether it occurs again."""
    order = [*_order(newest, path), F.col(ROW_HASH)]
    ranked = narrow.withColumn(_RANK, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col(_RANK) <= 2)
    first, second = (F.max(F.when(F.col(_RANK) == place, F.col(ROW_HASH))) for place in (1, 2))
    found = ranked.groupBy(*keys).agg(first.alias(ROW_HASH), second.alias("_second"))
    return found.select(*keys, ROW_HASH, F.col("_second").eqNullSafe(F.col(ROW_HASH)).alias("_again"))


def keep_latest(
    df: DataFrame,
    keys: Sequence[str],
    newest: str | None = None,
    path: str | None = None,
    needed: Sequence[str] = (),
    before: Callable[[DataFrame], DataFrame | Iterable[DataFrame]] | None = None,
    after: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """The newest row per key, chosen on narrow rows (A3).

    A time of NULL is the oldest; equal times go to the first ``path``, then to
    the smallest 64-bit hash of the row.  Where a winner occurs several times,
    equal in every column, one of them is kept.  A column ``ROW_HASH``, if there
    is one, is taken as the hash, so that a stored table is read by few columns
    only; it is dropped.

    Keys are counted first, by a hash aggregate over the key columns.  Up to
    ``REPEATED_KEYS`` that occur more than once are broadcast: only their rows
    are compared, by time and path and, of keys where these are equal, by the
    hash.  The others pass, and no whole row is shuffled.

    With more of them, and where ``before`` leaves out rows ahead of the choice
    by the columns ``needed``, or ``after`` chosen ones by their keys, say by an
    existence join, the choice goes by the places of rows in a stored table: only
    ``needed`` and then key and time are shuffled with the place, and what is
    chosen is a bit per row, broadcast to a scan.  Only rows of keys whose newest
    time occurs twice are compared by path and hash.  ``df`` is stored first
    unless it has the column ``ROW_PLACE``, which is dropped.

    Above ``places.PLACED_ROWS`` rows, or where a hash and no place is stored,
    key, time, path, the columns ``needed`` and the hash, if it is stored, are
    shuffled and sorted, and the whole rows of the winners fetched by a semi join
    on these.

    Repeated keys and chosen rows are stored in the scratch folder, so this runs
    jobs of its own.  ``before`` may give its rows as several frames, which are
    run one after the other.
    """
    if before is None and after is None:
        repeated = places.stored(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).filter("_rows > 1").select(*keys), "repeated")
        n_repeated = repeated.count()
        if not n_repeated:
            return df.drop(ROW_HASH, ROW_PLACE)
        if n_repeated <= REPEATED_KEYS:
            return _with_winners(df.drop(ROW_PLACE), keys, newest, path, repeated)
    if ROW_PLACE not in df.columns and ROW_HASH not in df.columns and (newest or path):
        df = places.placed(df, "rows")
    if ROW_PLACE in df.columns:
        if df.count() <= places.PLACED_ROWS:
            return _by_places(df, keys, newest, path, needed, before, after)
        df = df.drop(ROW_PLACE)
    if ROW_HASH not in df.columns and (newest or path):
        return _by_times(df, keys, newest, path, needed, before, after)
    return _by_hash(df, keys, newest, path, needed, before, after)


def _frames(found: DataFrame | Iterable[DataFrame]) -> Iterable[DataFrame]:
    return [found] if isinstance(found, DataFrame) else found


def _whole(found: DataFrame | Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionAll, _frames(found))


def _by_places(df: DataFrame, keys: Sequence[str], newest: str | None, path: str | None, needed: Sequence[str], before, after) -> DataFrame:
    """The newest rows of a stored table, chosen by key, time and place; by path and hash where several rows come first."""
    rows = df
    if before is not None:
        found = before(df.select(*dict.fromkeys([*needed, ROW_PLACE])))
        rows = places.marked(df, places.marks(some.select(ROW_PLACE) for some in _frames(found)))
    narrow = rows.select(*dict.fromkeys([*keys, *_times(newest, None), ROW_PLACE]))
    parts = places.n_parts(narrow.count())

    def first(part: int) -> DataFrame:
        some = _first(narrow.filter(places.in_part(keys, part, parts)), keys, newest, None, [*keys, ROW_PLACE])
        some = some if after is None else after(some)
        # The key is needed again of tied rows only.
        return some.select(ROW_PLACE, "_tied", *[F.when(F.col("_tied"), F.col(f"`{c}`")).alias(c) for c in keys])

    chosen = places.stored(map(first, range(parts)), "first")
    single = chosen.filter("NOT _tied").select(ROW_PLACE)
    tied = chosen.filter("_tied").select(*keys)
    if tied.isEmpty():
        return places.marked(df, places.marks(single)).drop(ROW_PLACE, ROW_HASH)

    def of_tied(part: int) -> DataFrame:
        side, same = _chosen(tied.filter(places.in_part(keys, part, parts)), keys)
        return narrow.filter(places.in_part(keys, part, parts)).join(side, same, "left_semi").select(ROW_PLACE)

    whole = places.marked(df, places.marks(map(of_tied, range(parts))))
    hashed = _hashed(df.drop(ROW_PLACE), whole).select(*dict.fromkeys([*keys, *_times(newest, path), ROW_HASH, ROW_PLACE]))
    order = [*_order(newest, path), F.col(ROW_HASH), F.col(ROW_PLACE)]
    ranked = hashed.withColumn(_RANK, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col(_RANK) == 1)
    return places.marked(df, places.marks([single, ranked.select(ROW_PLACE)])).drop(ROW_PLACE, ROW_HASH)


def _by_hash(df: DataFrame, keys: Sequence[str], newest: str | None, path: str | None, needed: Sequence[str], before, after) -> DataFrame:
    """The newest rows, chosen and fetched by the hash of every row."""
    hashed = _hashed(df, df)
    rows = hashed.select(*dict.fromkeys([*keys, *needed, *_times(newest, path), ROW_HASH]))
    chosen = _winners(rows if before is None else _whole(before(rows)), keys, newest, path)
    chosen = places.stored(chosen if after is None else after(chosen), "latest")

    def fetched(winners: DataFrame) -> DataFrame:
        side, same = _chosen(winners, keys)
        return hashed.join(side, same & (F.col(ROW_HASH) == F.col(f"_chosen_{ROW_HASH}")), "left_semi").drop(ROW_HASH)

    again = chosen.filter("_again")
    if again.isEmpty():
        return fetched(chosen)
    return fetched(chosen.filter("NOT _again")).unionAll(fetched(again).dropDuplicates(list(keys)))


def _by_times(df: DataFrame, keys: Sequence[str], newest: str | None, path: str | None, needed: Sequence[str], before, after) -> DataFrame:
    """The newest rows, chosen and fetched by time, path and the needed columns; by the hash where several rows come first."""
    columns = [*dict.fromkeys([*keys, *needed, *_times(newest, path)])]
    rows = df.select(*columns)
    first = _first(rows if before is None else _whole(before(rows)), keys, newest, path, columns)
    first = places.stored(first if after is None else after(first), "first")
    tied = first.filter("_tied")
    single, same = _chosen(first.filter("NOT _tied").drop("_tied"), columns)
    if tied.isEmpty():
        return df.join(single, same, "left_semi")
    side, of_tied = _chosen(tied.select(*keys), keys)
    return df.join(single, same, "left_semi").unionAll(_by_hash(df.join(side, of_tied, "left_semi"), keys, newest, path, needed, before, after))


def _with_winners(df: DataFrame, keys: Sequence[str], newest: str | None, path: str | None, repeated: DataFrame) -> DataFrame:
    """Rows whose keys are not ``repeated``, and the newest row of those that are; a row is hashed only where nothing else decides."""
    times = _times(newest, path)

    def of(some: DataFrame) -> DataFrame:
        side, same = _chosen(some.select(*keys), keys)
        return df.join(F.broadcast(side), same, "left_semi")

    first = tied = repeated
    if times:
        columns = [*keys, *times]
        first = places.stored(_first(of(repeated).select(*columns), keys, newest, path, columns), "first")
        tied = first.filter("_tied").select(*keys)
    narrow = _hashed(df, of(tied)).select(*dict.fromkeys([*keys, *times, ROW_HASH]))
    hashes = places.stored(_winners(narrow, keys, newest, path), "latest") if not tied.isEmpty() else None
    columns = [F.col(f"`{c}`") for c in df.columns if c != ROW_HASH]
    code = F.col(ROW_HASH) if ROW_HASH in df.columns else row_hash(df)
    wins = reduce(and_, [F.col(f"`{c}`").eqNullSafe(F.col(f"`_first_{c}`")) for c in times], F.lit(True))
    side, same = _chosen(first.withColumnsRenamed({c: f"_first_{c}" for c in times}).withColumn("_repeated", F.lit(True)), keys)
    met = df.join(F.broadcast(side), same, "left").filter(F.col("_repeated").isNull() | wins)
    if hashes is None:
        return met.select(*columns)
    side, same = _chosen(hashes, keys)
    wins = code == F.col(f"_chosen_{ROW_HASH}")
    met = met.select(*[F.col(f"`{c}`") for c in df.columns]).join(F.broadcast(side), same, "left")
    kept = met.filter(F.col("_again").isNull() | (~F.col("_again") & wins)).select(*columns)
    if hashes.filter("_again").isEmpty():
        return kept
    again = df.join(F.broadcast(side.filter("_again")), same, "inner").filter(wins).select(*columns)
    return kept.unionAll(again.dropDuplicates(list(keys)))
