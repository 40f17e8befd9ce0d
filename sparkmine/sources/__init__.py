from sparkmine.sources.index import with_dense_index, with_group_rank  # noqa: F401
from sparkmine.sources.sinks import write_results  # noqa: F401
from sparkmine.sources.tables import baskets  # noqa: F401
from sparkmine.sources.text import read_lines, read_points, read_transactions  # noqa: F401
