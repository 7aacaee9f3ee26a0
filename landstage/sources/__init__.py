from landstage.sources.readers import read_jdbc, read_paths, read_table
from landstage.sources.trees import discover_files, list_tree, read_tree

__all__ = ["discover_files", "list_tree", "read_jdbc", "read_paths", "read_table", "read_tree"]
