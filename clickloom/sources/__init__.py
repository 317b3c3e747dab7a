from clickloom.sources.files import (
    cut_by_position, read_click_logs, read_comma_csv, read_predictions, read_space_text, with_file_rows, write_comma_csv,
    write_space_text,
)
from clickloom.sources.schema import PREDICTION_SCHEMA, click_schema
from clickloom.sources.stage import new_path, shared_folder, spread, stage
from clickloom.sources.store import content_key, kept
from clickloom.sources.tables import click_log, table

__all__ = [
    "PREDICTION_SCHEMA", "click_log", "click_schema", "content_key", "cut_by_position", "kept", "new_path", "read_click_logs", "read_comma_csv",
    "read_predictions", "read_space_text", "shared_folder", "spread", "stage", "table", "with_file_rows",
    "write_comma_csv", "write_space_text",
]
