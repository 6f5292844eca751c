"""loomtext: a Spark-native document analytics engine."""

__version__ = "0.1.0"

VERSION = (0, 2, 0)


def version(commit_time: int | None = None) -> str:
    """major.minor.patch, and the commit's time where it is known."""
    return ".".join(str(x) for x in (*VERSION, *([] if commit_time is None else [commit_time])))
