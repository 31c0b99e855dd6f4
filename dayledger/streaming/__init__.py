from dayledger.streaming.ingest import stream_ingest
from dayledger.streaming.promotion import promotions, stream_promotions

__all__ = ["promotions", "stream_ingest", "stream_promotions"]
