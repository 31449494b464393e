"""Writers: quarantine, bronze, partitioned tables, physical layouts."""
