"""Streaming.

The reference is a batch pipeline over a monthly panel: it has no streams in the
Structured Streaming sense (no watermarks, windows over event time, state or late
events; "late" there means late revenue statements inside a batch panel). Nothing
is built here on purpose; a monthly refresh is one batch run of
``fillwise.plans.final_view.run_nowcast_and_audit`` on the new panel.
"""
