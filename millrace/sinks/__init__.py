"""Writers for whole tables, touched partitions and dated snapshots."""
