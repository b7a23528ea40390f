"""Flag, issue and reason texts, categories and severities.

Results are compared by these texts, so they must not be reworded.  ``{name}``
marks where a column value goes (see ``functions.fill``).
"""

# Kahn categories
VALUE_CONFORMANCE = "Conformance - Value Conformance"
TEMPORAL = "Plausibility - Temporal Plausibility"
ATEMPORAL = "Plausibility - Atemporal Plausibility"
COMPLETENESS = "Completeness"

# Severities
HIGH = "High"
MEDIUM = "Medium"
LOW = "Low"

# Answer sources
CODED_YES = "Coded Yes"
TEXT_YES = "Text Yes"

# Rule 1: gender
GENDER_NULL = "Gender is NULL"
GENDER_NON_STANDARD = "Non-standard gender value: {gender}"

# Rule 2: visit after death
VISIT_AFTER_DEATH = "Encounter recorded {days} day(s) after recorded death date of {death}"

# Rule 3: treatment before birth
DET_BIRTHDATE_MISSING = "Missing birthdate"
DET_START_MISSING = "Missing ART start date"
DET_START_BEFORE_BIRTH = "ART started before birth"
CEN_BIRTHDATE_NULL = "Birthdate is NULL - cannot verify"
CEN_START_NULL = "ART start date is NULL - cannot verify"
CEN_START_BEFORE_BIRTH = "ART initiated {days} day(s) before recorded birthdate"

# Rule 4: pregnancy or breastfeeding of male clients
MALE_OBSERVATION = "Male patient has: {question} - observation recorded as Yes on {day}"

# Rule 5: pregnancy or breastfeeding outside reproductive age
DET_AGE_OUTSIDE = "Age outside 8-55 at time of observation"
CEN_AGE_UNKNOWN = "Birthdate missing - age at observation unverifiable"
CEN_AGE_BELOW = "Patient was {age} years old at obs - below minimum reproductive age of 8"
CEN_AGE_ABOVE = "Patient was {age} years old at obs - above maximum reproductive age of 55"

# Rule 6: implausible treatment date
DET_START_EARLY = "ART start date before 1985"
DET_START_FUTURE = "ART start date in the future"
CEN_START_IS_NULL = "ART start date is NULL"
CEN_START_EARLY = "ART start date {start} is before 1985 - predates existence of ART"
CEN_START_FUTURE = "ART start date {start} is in the future"

# Rule 7: missing measurements at a paediatric visit
DET_ALL_MISSING = "Weight, Height and BMI all missing"
DET_WEIGHT_HEIGHT_MISSING = "Weight and Height missing"
DET_WEIGHT_MISSING = "Weight missing"
DET_HEIGHT_MISSING = "Height missing"
DET_BMI_MISSING = "BMI missing"
CEN_ALL_MISSING = "Weight, Height and BMI all missing at this visit"
CEN_WEIGHT_HEIGHT_MISSING = "Weight and Height missing at this visit"
CEN_WEIGHT_MISSING = "Weight missing at this visit"
CEN_HEIGHT_MISSING = "Height missing at this visit"
CEN_BMI_MISSING = "BMI missing at this visit"

# Rule 8: adults without height
DET_NO_HEIGHT_AGE_UNKNOWN = "Height missing - birthdate unknown, age unverifiable"
DET_NO_HEIGHT_OLD = "Height missing - implausible age"
DET_NO_HEIGHT = "Height never recorded"
CEN_NO_HEIGHT_AGE_UNKNOWN = "Height never recorded - birthdate unknown, age unverifiable"
CEN_NO_HEIGHT_OLD = "Height never recorded - current age of {age} years is implausible"
CEN_NO_HEIGHT = "Height never recorded for adult patient enrolled on {enrolled}"

# Rule 9: pregnant at treatment start
DET_PREGNANT_AT_START = "Pregnant at ART initiation"
CEN_PREGNANT_START_NULL = "ART start date missing - cannot verify pregnancy timing"
CEN_PREGNANT_AT_START = (
    "Pregnancy observation recorded {days} day(s) {side} ART initiation date of {start}"
)
BEFORE = "before"
AFTER = "after"

# Rule 10: breastfeeding
DET_BREASTFEEDING_OLD = "Breastfeeding obs older than 24 months - verify"
DET_BREASTFEEDING = "Currently breastfeeding"
CEN_BREASTFEEDING_OLD = (
    "Breastfeeding status last confirmed: {days} days ago"
    " - exceeds 24 month biological limit, verify if still current"
)
CEN_BREASTFEEDING = "Patient currently recorded as breastfeeding as of {day}"

# Reasons written by the voiding corrections
VOID_VISIT_REASON = "Encounter recorded after confirmed death date - under review"
VOID_OBS_REASON = (
    "Pregnancy/breastfeeding observation recorded on male patient - data entry error"
)

# Spellings the gender correction understands
MALE_SPELLINGS = ("male", "m")
FEMALE_SPELLINGS = ("female", "f")
