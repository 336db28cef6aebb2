from flowtally.sources.files import (read_clean, read_raw_csv, read_result_jdbc,
                                    read_result_parts, read_result_table)
from flowtally.sources.stream import file_stream

__all__ = ["read_clean", "read_raw_csv", "read_result_jdbc", "read_result_parts",
           "read_result_table", "file_stream"]
