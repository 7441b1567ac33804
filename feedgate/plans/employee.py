"""The employee table's contract."""

from __future__ import annotations

from feedgate.contract import Field, TableContract
from feedgate.functions import rules

EMPLOYEE = TableContract(
    name="employee",
    key="employee_id",
    fields=(
        Field("employee_id", "uuid"),
        Field("first_name"),
        Field("last_name"),
        Field("email"),
        Field("phone_number", protect=True),
        Field("hire_date", "date"),
        Field("department"),
        Field("job_title"),
        Field("salary", "decimal", protect=True),
        Field("currency", width=3),
        Field("employment_status"),
        Field("manager_id", "uuid"),
        Field("is_active", "boolean"),
        Field("skills", "list"),
        Field("address", "json"),
        Field("emergency_contact", "json", protect_key="phone"),
    ),
    # The limits of the stored columns.
    rules=(
        rules.key_present("employee_id"),
        rules.length_between("first_name", 3, 15),
        rules.length_between("last_name", 0, 15),
        rules.length_between("email", 13, 30),
        rules.email_shape("email"),
        rules.length_between("phone_number", 10, 15),
        rules.length_between("department", 0, 20),
        rules.length_between("job_title", 0, 30),
        rules.trimmed_length("currency", 3),
        rules.length_between("employment_status", 3, 13),
        rules.not_negative("salary"),
    ),
    checks=(rules.stored_width("currency", 3),),
)
