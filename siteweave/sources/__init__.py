from .sinks import (  # noqa: F401
    append,
    append_new,
    read_graph,
    read_upserted,
    upsert,
    upsert_table,
    write_graph,
    write_snapshot,
)
from .tables import (  # noqa: F401
    explode_list,
    lookup_by_ids,
    net_new,
    read_landed,
    read_payload,
    read_table,
    search_first,
    split_rejects,
    spread,
)
