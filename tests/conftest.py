import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from medstar.session import get_session
    s = get_session(master="local[4]", shuffle_partitions=4)
    yield s
    s.stop()


def above_broadcasts(df) -> list[str]:
    """Names of the operators that ran outside broadcast sides."""
    names = []

    def walk(node):
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if name.startswith("Broadcast") and "Join" not in name:
            return None
        if name.endswith("QueryStageExec"):
            return walk(node.plan())
        names.append(name)
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return names
