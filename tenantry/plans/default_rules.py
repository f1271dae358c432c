"""The default anonymization rules and the default checks.

Names, patterns, order, bounds and conditions are fixed values: results have to
agree with them.
"""

from __future__ import annotations

from tenantry.model import AnonymizationRule, BusinessRule, RequiredFields

# Rules in match order; the first whose pattern occurs in a column name wins.
ANONYMIZATION_RULES = (
    AnonymizationRule("email_addresses", ".*email.*", "surrogate", "email"),
    AnonymizationRule("ssn", ".*ssn.*|.*social_security.*", "hash", options={"algorithm": "sha256"}),
    AnonymizationRule("first_names", ".*first_name.*|.*given_name.*|.*fname.*", "surrogate", "first_name"),
    AnonymizationRule("last_names", ".*last_name.*|.*family_name.*|.*lname.*|.*surname.*", "surrogate", "last_name"),
    AnonymizationRule("full_names", ".*full_name.*|.*display_name.*", "surrogate", "name"),
    AnonymizationRule("phone_numbers", ".*phone.*|.*mobile.*|.*telephone.*|.*tel_.*", "surrogate", "phone_number"),
    AnonymizationRule("street_addresses", ".*street.*|.*address_line.*|.*addr_.*", "surrogate", "street_address"),
    AnonymizationRule("cities", ".*city.*", "surrogate", "city"),
    AnonymizationRule("states", ".*state.*", "preserve"),
    AnonymizationRule("zip_codes", ".*zip.*|.*postal.*", "surrogate", "zipcode"),
    AnonymizationRule(
        "birth_dates", ".*birth.*|.*dob.*", "surrogate", "date_of_birth", {"minimum_age": 5, "maximum_age": 85}
    ),
    AnonymizationRule("entity_ids", ".*_id$|.*_key$", "preserve"),
    AnonymizationRule("usernames", ".*username.*|.*user_name.*|.*login.*", "surrogate", "user_name"),
    AnonymizationRule("passwords", ".*password.*|.*passwd.*|.*pwd.*", "nullify"),
    AnonymizationRule("ip_addresses", ".*ip_address.*|.*ip_addr.*", "surrogate", "ipv4"),
    AnonymizationRule("urls", ".*url.*|.*website.*", "surrogate", "url"),
)

# Formats the anonymized columns must have.
EMAIL_FORMAT = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"
PHONE_FORMAT = "^[0-9]{3}-[0-9]{3}-[0-9]{4}$"

# Row rules, as Spark SQL predicates.
BUSINESS_RULES = (
    BusinessRule(
        "student_age_range", "ids_students", "age >= 5 AND age <= 22", "WARNING", "Students must be between 5 and 22 years old"
    ),
    BusinessRule(
        "enrollment_date_logical",
        "ids_enrollments",
        "enrollment_date < graduation_date OR graduation_date IS NULL",
        "ERROR",
        "Enrollment date must be before graduation date",
    ),
    BusinessRule(
        "staff_employment_dates",
        "ids_staff",
        "hire_date < termination_date OR termination_date IS NULL",
        "ERROR",
        "Hire date must be before termination date",
    ),
    BusinessRule(
        "grade_level_range",
        "ids_students",
        "grade_level >= 0 AND grade_level <= 12",
        "WARNING",
        "Grade level must be K-12 (represented as 0-12)",
    ),
    BusinessRule(
        "email_format_valid",
        "ids_students",
        f"email RLIKE r'{EMAIL_FORMAT}' OR email IS NULL",
        "WARNING",
        "Anonymized emails should be valid format",
    ),
    BusinessRule(
        "phone_format_valid",
        "ids_students",
        f"phone RLIKE '{PHONE_FORMAT}' OR phone IS NULL",
        "WARNING",
        "Phone numbers should match expected format",
    ),
    BusinessRule(
        "attendance_in_school_year",
        "ids_attendance",
        "attendance_date >= '2024-08-01' AND attendance_date <= '2025-06-30'",
        "WARNING",
        "Attendance dates should be within school year",
    ),
)

# Columns that must be there and filled.
COMPLETENESS_RULES = (
    RequiredFields(
        "student_required_fields", "ids_students", ("id", "district_id", "first_name", "last_name", "grade_level"), "ERROR"
    ),
    RequiredFields("school_required_fields", "ids_schools", ("id", "district_id", "name", "state"), "ERROR"),
)
