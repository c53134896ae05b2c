from chronoframe.sources.compaction import compact, recover
from chronoframe.sources.dataset import (
    append_local, assert_unique_key, copy_dataset, merge_datasets, repack, scan, unique_values,
    write_partitioned,
)
from chronoframe.sources.files import (
    domain_names, read_csv_table, read_domains, read_features, read_split_ids, select_domains,
    write_csv_table, write_domains, write_features, write_split_ids,
)

__all__ = [
    "append_local", "assert_unique_key", "compact", "copy_dataset", "recover", "merge_datasets", "repack", "scan",
    "unique_values", "write_partitioned", "domain_names", "read_csv_table", "read_domains",
    "read_features", "read_split_ids", "select_domains", "write_csv_table", "write_domains",
    "write_features", "write_split_ids",
]
