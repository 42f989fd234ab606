from tidemark.sources.files import (file_inventory, latest_file, read_csv, read_json, read_ndjson,
                                    read_parquet, read_text)

__all__ = ["file_inventory", "latest_file", "read_csv", "read_json", "read_ndjson", "read_parquet",
           "read_text"]
