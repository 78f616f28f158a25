"""The indexes that a schema declares, built for the tables of a catalog."""

from __future__ import annotations

from recordspark.sources import layout, search_index, vector_index
from recordspark.sources.catalog import Catalog
from recordspark.sources.schema import DISTANCES, TableSchema
from recordspark.sources.storage import new_folder


def build_indexes(catalog: Catalog, schema: TableSchema, folder: str | None = None, buckets: int = layout.BUCKETS) -> Catalog:
    """Build all indexes of a schema over the rows of its table, and have the catalog's queries use them.

    Vector and search indexes are used wherever they fit; standard and unique ones are layouts that a hint picks by the
    index's name.  Of two vector indexes of a field the last counts.  folder: where they are written, the shared folder
    without it.  All rows are indexed, those that readers may not see too: scans of an index see what scans of the
    table see.
    """
    if schema.name not in catalog.tables:
        raise KeyError(f"unknown table: {schema.name}")
    t = catalog.tables[schema.name]
    for i in schema.indexes:
        path = f"{folder}/{schema.name}-{i.name}" if folder else new_folder(catalog.spark, f"{schema.name}-{i.name}")
        if i.kind in DISTANCES:
            catalog.add_vector_index(schema.name, vector_index.build(t.load(), i.columns[0], i.distance, path))
        elif i.kind == "search":
            catalog.add_search_index(schema.name, search_index.build(t.load(), t.key, i.columns, path))
        else:
            catalog.add_layout(schema.name, layout.write(t.load(), i.name, i.columns, path, buckets))
    return catalog
