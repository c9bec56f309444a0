"""fillwise: revenue nowcast and audit engine on Spark.

Entry points: ``fillwise.plans.run`` (end-to-end file runs),
``fillwise.plans.final_view.run_nowcast_and_audit`` (panel -> deliverable and
audits), ``fillwise.plans.catalog.REGISTRY`` (one query per operator).
"""

__version__ = "0.1.0"
