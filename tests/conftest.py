import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from reportlens.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    return local_session(
        cores=8,
        memory="4g",
        **{
            "spark.sql.warehouse.dir": str(base / "warehouse"),
            "spark.checkpoint.dir": str(base / "scratch"),
        },
    )


REPORTS = '''VAERS_ID,STATE,AGE_YRS,CAGE_YR,DIED,HOSPITAL,SYMPTOM_TEXT
1,CA,70,70,Y,Y,"line1
line2 ""q"""
2,TX,,33,,Y,ok
3,NY,17.5,17,,,
4,,,,Y,,
5,FL,65,65,,,first copy
5,FL,65,65,,,second copy
6,US,40,,N,Y,
7,CA,50,50,,,not covid
8,CA,64.9,64,,Y,
11,PA,,,Y,,
'''
VACCINES = """VAERS_ID,VAX_TYPE,VAX_MANU
1,COVID19,PFIZER\\BIONTECH
1,COVID19,PFIZER\\BIONTECH
2,COVID19,MODERNA
2,FLU4,PFIZER\\WYETH
3,covid19 , Janssen 
4,COVID19-2,UNKNOWN MANUFACTURER
5,COVID19,Moderna
6,UNK,NOVAVAX
6,COVID19,JOHNSON & JOHNSON
7,FLU4,SANOFI PASTEUR
8,UNK,PFIZER\\BIONTECH
9,COVID19,MODERNA
10,,
11,COVID19,PFIZER\\BIONTECH
"""
SYMPTOMS = """VAERS_ID,SYMPTOM1,SYMPTOM2
1,Myocarditis,Fever
1,Headache,Rash
2, myocarditis ,Rash
2,Dyspnoea,
2,,Rash
3,Intestinal obstruction,
3,Soft tissue swelling,
3,Rash,
4,Rash,
5,Flu,
5,Tachycardia,
6,Pyrexia,
6,Fever,
7,Rash,
8,"",
8,Chest pain,
8,SARS-CoV-2 test positive,
9,Rash,
11,Rash,
"""


@pytest.fixture(scope="session")
def data_dir(tmp_path_factory):
    """Folder with the three extracts of the domain fixture."""
    folder = tmp_path_factory.mktemp("extracts")
    for name, text in (
        ("VAERSDATA.csv", REPORTS),
        ("VAERSVAX.csv", VACCINES),
        ("VAERSSYMPTOMS.csv", SYMPTOMS),
    ):
        (folder / name).write_text(text)
    return str(folder)
