from __future__ import annotations

import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

# Hand-made CSV fixtures (FIXTURES.md section 2).
FEATURES_1 = """id,c1,c2,c3,c4,c5,n1,n2
r1,a,x,p,u,k,1.0,10
r2,b,x,q,u,k,2.5,20
r3,,y,p,v,k,-1.5,30
"""
FEATURES_2 = """id,c1,c2,c3,c4,c5,n1,n2
r4,a,y,q,v,k,0.0,40
r5,c,x,p,u,k,4.0,50
"""
LABELS = """id,label
r1,11.0
r2,22.0
r2,23.0
r3,-2.5
r4,44.0
r9,99.0
"""
SHORT = """id,c1,c2,c3,c4,c5,n1,n2
r6,a,x,p,u,k,1.0
"""
SCORE = """id,c1,c2,c3,c4,c5,n1,n2
s1,z,x,p,u,k,1.0,10
s2,a,y,q,v,k,2.0,20
"""


@pytest.fixture(scope="session")
def spark():
    from foldwise.session import local_session

    s = local_session("4", shuffle_partitions=8, app="foldwise-tests")
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture()
def fixture_dir():
    d = Path(tempfile.mkdtemp(prefix="foldwise-fixtures-"))
    (d / "features").mkdir()
    (d / "features" / "part1.csv").write_text(FEATURES_1)
    (d / "features" / "part2.csv").write_text(FEATURES_2)
    (d / "labels.csv").write_text(LABELS)
    (d / "short.csv").write_text(SHORT)
    (d / "score.csv").write_text(SCORE)
    return d


@pytest.fixture()
def fixture_spec():
    from foldwise.spec import FeatureSpec

    return FeatureSpec.positional(["id", "c1", "c2", "c3", "c4", "c5", "n1", "n2"])
