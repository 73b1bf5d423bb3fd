from .delimited import read_delimited, read_header, write_delimited  # noqa: F401
from .snapshots import land_json, read_snapshots, stringify, write_snapshot  # noqa: F401
from .tables import (  # noqa: F401
    load_gold, load_silver, table_path, write_gold, write_silver, write_table,
)
