"""Streaming: intentionally empty.

The reference processes closed monthly files only; it has no watermarks,
event-time windows, state or late data.  Late reports are handled in batch
by the month "leak" partitioning (``tidewater.operators.cdm.assign_period``)
and by the three-month runs of the buddy checks
(``tidewater.operators.buddy.with_target_months``).
"""
