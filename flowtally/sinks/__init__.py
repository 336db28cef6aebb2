from flowtally.sinks.files import (export_csv, save_result_table, write_csv_parts, write_jdbc,
                                  write_table)

__all__ = ["export_csv", "save_result_table", "write_csv_parts", "write_jdbc", "write_table"]
