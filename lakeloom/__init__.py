"""lakeloom — medallion (bronze → silver → gold) data work as Spark DataFrame functions.

Every operator takes and returns DataFrames (or a ``(clean, rejects)`` pair) so Catalyst
sees the whole plan; I/O lives only in :mod:`lakeloom.sources` and :mod:`lakeloom.plans`.
"""

from lakeloom.session import get_session, shared_dir

__all__ = ["get_session", "shared_dir"]
