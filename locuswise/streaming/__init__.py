"""Row-wise operators on streams.

The covered feature set has no stateful stream operator; predicates and per-read transforms are
plain columns, so they run on a streaming DataFrame as they are.
"""
