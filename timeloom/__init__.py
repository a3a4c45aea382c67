"""timeloom: event-timeline analytics as Spark DataFrame jobs.

Sites are a column, not a loop: every operator takes one DataFrame that holds
all sites and keys its work by ``site``, so one job covers the federation.
"""

from timeloom.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
