from brindle.sources.buckets import BucketedPair, joined_buckets, store_bucketed
from brindle.sources.local import from_pandas, to_pandas
from brindle.sources.sinks import read_partitions, replace_partitions
from brindle.sources.tables import TableSpec, qualified_name, read_table, warehouse_spec

__all__ = ["BucketedPair", "TableSpec", "from_pandas", "joined_buckets", "qualified_name", "read_partitions", "read_table", "replace_partitions", "store_bucketed", "to_pandas", "warehouse_spec"]
