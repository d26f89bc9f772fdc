"""Batch operators: ``DataFrame -> DataFrame`` functions over a log view.

A log view has at least ``service``, ``timestamp`` (epoch seconds, double)
and ``message``; the cumulative operators also need a numeric ``batch_id``
(arrival order) and the sampling operators a unique ``event_id``.
"""
