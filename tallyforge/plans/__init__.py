"""Report assembly: compositions of the operators."""

from .extract import extract_rows
from .ids import generate_ids
from .intake import IntakeResult, correct_intake, intake_pipeline
from .recordchange import RecordChange, record_change_pipeline
from .reports import report_tables
from .student import cut_rows, home_district_rows, reporting_cuts, split_special_schools, student_derivations

__all__ = [
    "IntakeResult", "RecordChange", "correct_intake", "cut_rows", "extract_rows", "generate_ids", "home_district_rows",
    "intake_pipeline", "record_change_pipeline", "report_tables", "reporting_cuts", "split_special_schools",
    "student_derivations",
]
