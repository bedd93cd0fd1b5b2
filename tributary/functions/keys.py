"""Deterministic surrogate keys and message keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tributary.functions.util import as_column
from tributary.schemas import KEY_SEPARATOR, NULL_KEY_TOKEN


def stable_key(*columns: Column | str) -> Column:
    """SHA-256 hex of the parts cast to string, null as ``__null__``.

    A literal ``__null__`` hashes like null, and a separator inside a value can
    collide; both are kept so keys stay stable across runs.
    """
    parts = [
        F.coalesce(as_column(c).cast("string"), F.lit(NULL_KEY_TOKEN)) for c in columns
    ]
    return F.sha2(F.concat_ws(KEY_SEPARATOR, *parts), 256)


def _present(column: Column) -> Column:
    return column.isNotNull() & (F.length(column) > 0)


def message_key(
    wiki: Column | str = "wiki",
    title: Column | str = "title",
    meta_id: Column | str = "meta_id",
) -> Column:
    """Kafka record key: ``wiki:title``, else ``wiki``, else ``meta.id``, else null."""
    wiki, title, meta_id = as_column(wiki), as_column(title), as_column(meta_id)
    return (
        F.when(_present(wiki) & _present(title), F.concat(wiki, F.lit(":"), title))
        .when(_present(wiki), wiki)
        .when(_present(meta_id), meta_id)
    )
