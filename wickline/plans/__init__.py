from wickline.plans.adhoc import ask_sql
from wickline.plans.incremental import ingest_new
from wickline.plans.jobs import aggregate, ingest, refine, run_pipeline

__all__ = ["aggregate", "ask_sql", "ingest", "ingest_new", "refine", "run_pipeline"]
