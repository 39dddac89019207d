"""Readers, writers, layer paths and session settings."""

from lakemart.sources.datasets import DATASETS, Dataset, dataset
from lakemart.sources.jdbc import JdbcTarget, prepare_for_jdbc, write_jdbc
from lakemart.sources.paths import Lake, list_files, list_tables, path_exists, scratch_path
from lakemart.sources.readers import (
    open_or_init,
    read_as,
    read_csv,
    read_documents,
    read_json,
    read_layer,
    read_required,
    read_upstream,
    split_rejects,
)
from lakemart.sources.session import build_session, object_store_conf, session_conf
from lakemart.sources.writers import create_table_if_absent, write_as, write_csv, write_json, write_layer, write_parquet

__all__ = [
    "DATASETS",
    "Dataset",
    "JdbcTarget",
    "Lake",
    "build_session",
    "create_table_if_absent",
    "dataset",
    "list_files",
    "list_tables",
    "object_store_conf",
    "open_or_init",
    "path_exists",
    "prepare_for_jdbc",
    "read_as",
    "read_csv",
    "read_documents",
    "read_json",
    "read_layer",
    "read_required",
    "read_upstream",
    "scratch_path",
    "session_conf",
    "split_rejects",
    "write_as",
    "write_csv",
    "write_jdbc",
    "write_json",
    "write_layer",
    "write_parquet",
]
