from landstage.streaming.incremental import run_incremental

__all__ = ["run_incremental"]
