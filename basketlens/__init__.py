"""Purchase-history analytics as Spark DataFrame jobs.

Every operator is a plain function ``DataFrame(s) + keyword parameters ->
DataFrame``; nothing runs until a sink or an action is called.
"""

__version__ = "0.1.0"
