from tutela.sources.literal import lookup
from tutela.sources.digest import table_digest
from tutela.sources.manifest import read_manifest
from tutela.sources.publication import Store
from tutela.sources.text import read_text_csv, read_typed_csv
from tutela.sources.warehouse import read_tables, write_table, write_tables

__all__ = ["Store", "lookup", "read_manifest", "read_tables", "read_text_csv", "read_typed_csv",
           "table_digest", "write_table", "write_tables"]
