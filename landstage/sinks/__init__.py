from landstage.sinks.runs import finished, finished_files, record_run, runs, write_run
from landstage.sinks.trees import copy_files, copy_parquet_tree
from landstage.sinks.writers import (json_documents, write_jdbc, write_json,
                                     write_parquet, write_table)

__all__ = ["copy_files", "copy_parquet_tree", "finished", "finished_files", "json_documents", "record_run", "runs",
           "write_jdbc", "write_json", "write_parquet", "write_run", "write_table"]
