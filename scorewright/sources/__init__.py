from scorewright.sources.tables import scan, constants, table_path  # noqa: F401
from scorewright.sources.snapshot import latest_snapshot, as_of, scalar_value  # noqa: F401
from scorewright.sources.sinks import overwrite, append_all, materialise, read_back  # noqa: F401
