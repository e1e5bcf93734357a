"""Keep-first, and lists per repository as rows of bounded parts.

A repository may own a large part of all rows, so a list is never built in one
piece: every list, short or long, is a number of parts, dealt by a hash of
the item.  ``whole_lists`` puts the parts of chosen repositories together.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Distinct items that a part holds at most, half of it on average in a long list.
PART_ITEMS = 2_000


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The first row by ``order`` of each ``keys`` group; NULL keys are equal.

    An aggregate, not a window: copies are reduced before the shuffle, so a key
    held by a third of all rows costs no more than one row per task.
    """
    rest = [c for c in df.columns if c not in keys]
    rank = F.struct(*[F.col(c) if isinstance(c, str) else c for c in order])
    best = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), rank).alias("_first"))
    return best.select(*keys, *[F.col("_first").getField(c).alias(c) for c in rest]).select(*df.columns)


def section_counts(section: str, rows: DataFrame, key: str = "repo_id") -> DataFrame:
    return rows.groupBy(key).agg(F.count(F.lit(1)).alias("n_items")).select(
        F.col(key), F.lit(section).alias("section"), "n_items"
    )


def list_parts(
    rows: DataFrame, items: Sequence[Column | str], part_items: int = PART_ITEMS, key: str = "repo_id"
) -> DataFrame:
    """(key, part, items): all rows, as sorted lists of (item, copies).

    Equal rows are one item with a count, reduced before the shuffle, so a value repeated any
    number of times is one entry.  The number of parts of a key follows from its
    number of rows, joined to them: a row per key, broadcast or split by adaptive
    execution as it is small or the key large.
    """
    items = rows.select(key, _item(items).alias("item"))
    sizes = items.groupBy(key).agg(F.ceil(F.count(F.lit(1)) * 2 / F.lit(part_items)).cast("int").alias("_parts"))
    part = F.pmod(F.xxhash64("item"), F.col("_parts")).cast("int").alias("part")
    dealt = items.join(sizes, key).select(key, part, "item")
    single = dealt.groupBy(key, "part", "item").agg(F.count(F.lit(1)).alias("copies"))
    # no entry is null, so sort_array orders as array_sort, without its comparator that is interpreted per pair
    return single.groupBy(key, "part").agg(F.sort_array(F.collect_list(F.struct("item", "copies"))).alias("items"))


def whole_lists(parts: DataFrame, name: str, key: str = "repo_id") -> DataFrame:
    """(key, name): the sorted list of every key in ``parts``, with its copies.

    For a document that holds the list whole; choose the keys first.
    """
    # an item is in one part only, so entries are sorted before their copies are laid out; a null item goes last
    entries = F.transform("items", lambda x: F.struct(x["item"].isNull().alias("none"), x["item"].alias("item"), x["copies"].cast("int").alias("copies")))
    listed = F.sort_array(F.flatten(F.collect_list(entries)))
    return parts.groupBy(key).agg(F.flatten(F.transform(listed, lambda x: F.array_repeat(x["item"], x["copies"]))).alias(name))


def _item(items: Sequence[Column | str]) -> Column:
    if len(items) == 1:
        only = items[0]
        return F.col(only) if isinstance(only, str) else only
    return F.struct(*items)
