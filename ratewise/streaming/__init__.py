from ratewise.streaming.pair_stream import score_pair_stream

__all__ = ["score_pair_stream"]
