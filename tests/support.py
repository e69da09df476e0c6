"""Helpers that tests import by name; a second conftest in a subfolder would hide the first."""

SMOKE = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    """The physical plan after execution, as adaptive execution left it."""
    df._jdf.collectToPython()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0]
