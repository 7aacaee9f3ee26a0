from landstage.plans.spec import LoadSpec, Lookup, Unpivot, run_load

__all__ = ["LoadSpec", "Lookup", "Unpivot", "run_load"]
