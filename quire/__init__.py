"""quire: persona/job document analytics as Spark DataFrame plans.

Collections of paged documents plus one job description per collection go in;
document importance ranks, best section headings with their pages, relevant
page extracts and one nested result per collection come out.  Every step is a
DataFrame transformation so that all collections run in one plan.
"""

from quire.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
