"""Incremental runs of the same transform over a stream of raw shipment rows.

The contact transform is stateless (per-row cleanup, stream-static lookup joins, explode), so it
runs unchanged on a streaming DataFrame; no watermark or state store is involved.
"""
