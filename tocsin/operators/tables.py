"""Keyed tables: last arrival wins, upsert and schema growth."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def latest_per_key(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The last row per key by ``order``; the other columns settle ties, so the
    result does not depend on how rows were spread.

    An aggregate rather than a window: many versions of one key are folded in
    each task before the shuffle, so a hot key sends one row from each. Folding
    rows with texts sorts a task's rows; select the needed columns first.
    """
    rest = [c for c in df.columns if c not in key and c not in order]
    newest = F.max(F.struct(*order, *rest)).alias("_row")
    picked = df.groupBy(*key).agg(newest)
    return picked.select(
        *[F.col(c) if c in key else F.col(f"_row.{c}").alias(c) for c in df.columns]
    )


def upsert(target: DataFrame, batch: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """``target`` with the rows of ``batch`` inserted or replaced by key.

    The last arrival of a key wins. A row with a null in its key matches nothing
    and is always inserted. ``order`` columns absent from the target are used for
    the choice only.
    """
    whole_key = F.lit(True)
    for k in key:
        whole_key = whole_key & F.col(k).isNotNull()
    keyed = latest_per_key(batch.filter(whole_key), key, order)
    incoming = keyed.unionByName(batch.filter(~whole_key)).select(target.columns)
    kept = target.join(keyed.select(*key), key, "left_anti")
    return kept.unionByName(incoming)


def add_missing(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Add the columns of ``schema`` that ``df`` lacks, filled with nulls."""
    new = [f for f in schema if f.name not in df.columns]
    return df.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in new])


def evolve(target: DataFrame, batch: DataFrame) -> DataFrame:
    """Union by name; a column that one side lacks is null there."""
    return target.unionByName(batch, allowMissingColumns=True)


#: Fixed order: a type may become any that stands behind it in its row.
_WIDENING = (
    ("tinyint", "smallint", "int", "bigint", "decimal(20,0)"),
    ("float", "double"),
    ("tinyint", "smallint", "int", "double"),
    ("date", "timestamp_ntz"),
)


def wider(one: T.DataType, other: T.DataType) -> T.DataType | None:
    """The type that holds all values of both without loss, None if neither does."""
    names = one.simpleString(), other.simpleString()
    if names[0] == names[1]:
        return one
    for row in _WIDENING:
        if names[0] in row and names[1] in row:
            return max(one, other, key=lambda t: row.index(t.simpleString()))
    return None


def schema_fit(table: T.StructType, offered: T.StructType) -> list[tuple[str, str | None, str | None, str]]:
    """What becomes of each column when rows of ``offered`` come to the table: ``same``,
    ``absent`` (null in the new rows), ``cast`` (up to the table's type), ``widen`` (the
    table's type grows), ``add``, or ``refuse``."""
    out = []
    for name in dict.fromkeys([*table.names, *offered.names]):
        held = table[name].dataType if name in table.names else None
        new = offered[name].dataType if name in offered.names else None
        if held is None or new is None:
            decision = "add" if held is None else "absent"
        else:
            common = wider(held, new)
            decision = "refuse" if common is None else "same" if held == new else "cast" if common == held else "widen"
        out.append((name, held and held.simpleString(), new and new.simpleString(), decision))
    return out


def fitted(df: DataFrame, table: T.StructType) -> tuple[DataFrame, T.StructType, list[str]]:
    """The rows in the shape the table gets, that shape, and the columns refused: those are
    left out of the rows and keep the table's type."""
    decisions = schema_fit(table, df.schema)
    kinds = {f.name: f.dataType for f in table} | {name: df.schema[name].dataType for name, _, _, d in decisions if d in ("add", "widen")}
    shape = T.StructType([T.StructField(name, kinds[name]) for name, *_ in decisions])
    refused = [name for name, _, _, d in decisions if d == "refuse"]
    given = [name for name in df.columns if name not in refused]
    rows = df.select(*[(F.col(f"`{f.name}`") if f.name in given else F.lit(None)).cast(f.dataType).alias(f.name) for f in shape])
    return rows, shape, refused


def union_all(*frames: DataFrame) -> DataFrame:
    """Concatenate, duplicates kept."""
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df)
    return out


def row_changes(before: DataFrame, after: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Rows whose number of copies differs: ``columns, rows_before, rows_after``.

    Both sides are counted in one aggregate. Nothing is joined, so repeated keys
    never multiply into pairs.
    """
    columns = columns or before.columns
    left = before.select(*columns, F.lit(1).alias("_b"), F.lit(0).alias("_a"))
    right = after.select(*columns, F.lit(0).alias("_b"), F.lit(1).alias("_a"))
    counted = left.unionByName(right).groupBy(*columns).agg(
        F.sum("_b").alias("rows_before"), F.sum("_a").alias("rows_after")
    )
    return counted.filter(F.col("rows_before") != F.col("rows_after"))


def change_feed(before: DataFrame, after: DataFrame, key: list[str]) -> DataFrame:
    """``key, change, before, after``: what happened to each key, with its other columns
    as structs; ``change`` is insert, update or delete.

    Rows equal on both sides are no change. A key with one differing row on each side is
    an update. Where a key repeats, or is null, rows can't be told apart by it: each row
    that is gone is a delete and each new one an insert. All is folded by key before it
    is dealt out; only repeated keys are looked at row by row.
    """
    rest = [c for c in before.columns if c not in key]
    rows = row_changes(before, after)
    gone = F.greatest(F.col("rows_before") - F.col("rows_after"), F.lit(0))
    new = F.greatest(F.col("rows_after") - F.col("rows_before"), F.lit(0))
    rows = rows.select(*key, F.struct(*rest).alias("_row"), gone.alias("_gone"), new.alias("_new"))
    whole = F.lit(True)
    for k in key:
        whole = whole & F.col(k).isNotNull()
    sides = [F.max(F.when(F.col(n) > 0, F.struct("_row"))).alias(c) for n, c in (("_gone", "before"), ("_new", "after"))]
    folded = rows.filter(whole).groupBy(*key).agg(F.sum("_gone").alias("_gone"), F.sum("_new").alias("_new"), *sides)
    single = folded.filter("_gone <= 1 AND _new <= 1")
    change = F.when(F.col("before").isNull(), "insert").when(F.col("after").isNull(), "delete").otherwise("update")
    paired = single.select(*key, change.alias("change"), F.col("before._row").alias("before"), F.col("after._row").alias("after"))
    repeated = folded.filter("_gone > 1 OR _new > 1").select(*key)
    apart = rows.join(repeated, key, "left_semi").unionByName(rows.filter(~whole))
    none = F.lit(None).cast(rows.schema["_row"].dataType)
    sides = F.array(
        F.struct(F.lit("delete").alias("change"), F.col("_row").alias("before"), none.alias("after"), F.col("_gone").alias("n")),
        F.struct(F.lit("insert").alias("change"), none.alias("before"), F.col("_row").alias("after"), F.col("_new").alias("n")),
    )
    each = apart.select(*key, F.explode(sides).alias("_side")).filter("_side.n > 0")
    copies = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_side.n")))
    each = each.select(*key, "_side.change", "_side.before", "_side.after", copies.alias("_copy")).drop("_copy")
    return paired.unionByName(each)
