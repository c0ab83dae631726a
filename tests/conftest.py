import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"

FIXTURE_CSV = """Invoice,StockCode,Description,Quantity,InvoiceDate,Price,Customer ID,Country
100001,A100,RED MUG,12,12/1/2009 7:45,6.95,501,United Kingdom
100001,A101,"  BLUE MUG ",6,12/1/2009 7:45,2.10,501,United Kingdom
C100002,A100,RED MUG,-2,12/2/2009 9:05,6.95,501,United Kingdom
100003,M,Manual,1,12/2/2009 9:10,10.00,501,United Kingdom
100004,BANK,BANK CHARGES,1,12/2/2009 9:15,15.00,,United Kingdom
100005,BANK," BANK CHARGES",1,12/2/2009 9:20,15.00,,United Kingdom
100006,A102,,3,12/3/2009 10:00,1.25,502,France
100007,A103,LAMP,,12/3/2009 10:05,9.00,502,France
100008,A103,LAMP,4,12/3/2009 10:10,,502,France
100009,A103,LAMP,1,12/3/2009 10:15,-5.00,502,France
100010,A103,LAMP,1,12/3/2009 10:20,0.00,502,France
100011,A100,RED MUG,1,10/5/2010 17:30,6.95,,France
100012,A104,VASE,1,1/1/2010 10:00,3.00,502,"   "
100013,A105,BOWL,2,,4.00,502,France
100001,A100,RED MUG,12,12/1/2009 7:45,6.95,501,United Kingdom
100014,m,LOWER,1,1/3/2010 10:00,2.00,503,France
100015,"  ",LID,1,1/4/2010 10:00,1.00,503,France
,A106,CUP,1,1/4/2010 10:05,1.00,503,France
"""


@pytest.fixture(scope="session")
def spark():
    from tillroll.session import build_session
    s = build_session(master="local[*]", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture
def fixture_csv(tmp_path):
    d = tmp_path / "src"
    d.mkdir()
    (d / "retail_fixture.csv").write_text(FIXTURE_CSV)
    return str(d)
