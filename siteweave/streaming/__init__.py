from .net_new import ingest_net_new  # noqa: F401
