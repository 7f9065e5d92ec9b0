"""Sources and sinks."""

from .files import (read_report_files, read_json, read_csv, read_fhir_dir,
                    read_resource, prepare_resource, write_csv, write_json,
                    write_report_documents)
from .tables import Catalog, save_table, read_table, TABLES

__all__ = ["read_report_files", "read_json", "read_csv", "read_fhir_dir",
           "read_resource", "prepare_resource", "write_csv", "write_json", "write_report_documents",
           "Catalog", "save_table", "read_table", "TABLES"]
