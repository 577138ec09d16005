from brindle.streaming.windows import current, late_rows, windowed_counts, write_updates

__all__ = ["current", "late_rows", "windowed_counts", "write_updates"]
