"""Names, codes, limits and patterns that results must carry exactly.

They are facts of the data contract, kept together as plain text.
"""

# --- fixed values: status axes, stages, outcomes -----------------------------------------

AXES = [
    "scan_status",
    "parse_status",
    "storage_status",
    "metadata_persistence_status",
    "validation_status",
    "binding_status",
    "index_status",
]
REPLAY_STAGES = ["scan", "parse", "storage", "metadata_persistence", "validation", "binding", "indexing"]
STAGE_NEEDS_REPLAY = ["failed", "pending", "awaiting_retry"]
OUTCOMES = ["accepted", "quarantined", "rejected", "failed"]
JOB_TRANSITIONS = {
    "created": ["receiving", "failed", "cancelled"],
    "receiving": ["scanning", "failed", "cancelled"],
    "scanning": ["processing", "failed", "cancelled"],
    "processing": ["finalizing", "failed", "cancelled"],
    "finalizing": ["completed", "failed", "cancelled"],
    "completed": ["reindexing", "failed"],
    "reindexing": ["completed", "failed", "cancelled"],
    "failed": [],
    "cancelled": [],
}
TERMINAL_JOB_STATES = ["completed", "failed", "cancelled"]

# --- fixed values: error codes -----------------------------------------------------------

NOT_IMAGE = "NotDicomFile"
PARSE_FAILED = "DicomParseFailed"
MISSING_TAG = "MissingRequiredDicomTag"
STORAGE_FAILED = "UploadPackageStoreFailed"
PERSISTENCE_FAILED = "MetadataPersistenceFailed"
UNREADABLE = "SourceFileUnreadable"
MISSING_ANNOTATION = "RequiredAnnotationMissing"
FILE_TOO_LARGE = "FileTooLarge"
MAX_ITEMS = "MaxItemsExceeded"
OUTSIDE_ROOT = "ManifestPathOutsideAllowedRoot"
FILE_NOT_FOUND = "ManifestFileNotFound"
DUPLICATE_SAMPLE = "DuplicateCuratedSampleId"
MANIFEST_UNREADABLE = "CuratedManifestUnreadable"
MANIFEST_INVALID = "CuratedManifestInvalidJson"
MANIFEST_NO_DATA = "CuratedManifestMissingDataPath"
DATA_OUTSIDE_ROOT = "CuratedManifestDataPathOutsideAllowedRoot"
DATA_INVALID = "CuratedManifestDataPathInvalid"
ANNOTATION_OUTSIDE_ROOT = "AnnotationPathOutsideAllowedRoot"
ANNOTATION_NOT_FOUND = "AnnotationPathMissing"
ARCHIVE_BOMB = "ZipBombDetected"
ARCHIVE_PATH = "UnsafeArchivePath"
ARCHIVE_DEPTH = "NestedZipTooDeep"

# --- fixed values: header tags -----------------------------------------------------------

IDENTITY_TAGS = [
    "SOPInstanceUID",
    "SOPClassUID",
    "StudyInstanceUID",
    "SeriesInstanceUID",
    "PatientID",
    "PatientName",
    "StudyDate",
    "StudyTime",
    "Modality",
    "SeriesNumber",
    "InstanceNumber",
    "TransferSyntaxUID",
]
MANDATORY_TAGS = ["SOPInstanceUID", "SOPClassUID", "StudyInstanceUID", "SeriesInstanceUID"]
RECOMMENDED_TAGS = ["PatientID", "PatientName", "StudyDate", "Modality", "SeriesNumber", "InstanceNumber"]
PIXEL_TAGS = ["PixelData", "FloatPixelData", "DoubleFloatPixelData"]
MAGIC = b"DICM"
MAGIC_OFFSET = 128

# --- fixed values: object class families, tested in this order ---------------------------

CLASS_FAMILIES = [
    ("1.2.840.10008.5.1.4.1.1.2", "CT"),
    ("1.2.840.10008.5.1.4.1.1.4", "MR"),
    ("1.2.840.10008.5.1.4.1.1.1", "CR/DX"),
    ("1.2.840.10008.5.1.4.1.1.6", "US"),
    ("1.2.840.10008.5.1.4.1.1.7", "SC"),
    ("1.2.840.10008.5.1.4.1.1.128", "PET"),
    ("1.2.840.10008.5.1.4.1.1.481", "RT"),
    ("1.2.840.10008.5.1.4.1.1.88", "SR"),
]

# --- fixed values: vendors ---------------------------------------------------------------

VENDOR_ALIASES = {
    "SIEMENS": ["SIEMENS", "SIEMENS HEALTHCARE", "SIEMENS MEDICAL", "SIEMENS HEALTHINEERS"],
    "GE": ["GE", "GE HEALTHCARE", "GENERAL ELECTRIC", "GENERAL ELECTRIC HEALTHCARE"],
    "PHILIPS": ["PHILIPS", "PHILIPS HEALTHCARE", "PHILIPS MEDICAL"],
    "UIH": ["UIH", "UNITED IMAGING", "UNITED IMAGING HEALTHCARE", "联影"],
    "CANON": ["CANON", "CANON MEDICAL", "CANON MEDICAL SYSTEMS", "TOSHIBA", "TOSHIBA MEDICAL"],
    "HITACHI": ["HITACHI", "HITACHI MEDICAL", "HITACHI HEALTHCARE"],
    "AGFA": ["AGFA", "AGFA HEALTHCARE"],
    "CARESTREAM": ["CARESTREAM", "CARESTREAM HEALTH"],
    "FUJIFILM": ["FUJIFILM", "FUJIFILM MEDICAL", "FUJI"],
}
VENDOR_SHORT = {
    "SIEMENS": "SIEM",
    "GE": "GE",
    "PHILIPS": "PHIL",
    "UIH": "UIH",
    "CANON": "CAN",
    "HITACHI": "HIT",
    "AGFA": "AGF",
    "CARESTREAM": "CS",
    "FUJIFILM": "FUJI",
    "GENERIC": "GEN",
}
VENDOR_A_NAMES = ["SIEMENS", "SIEMENS HEALTHCARE", "SIEMENS MEDICAL"]
VENDOR_A_MODALITIES = ["MR", "CT", "XA", "DX"]
VENDOR_B_NAMES = ["UIH", "UNITED IMAGING", "UNITED IMAGING HEALTHCARE", "联影", "上海联影"]
VENDOR_B_MODALITIES = ["MR", "CT", "DR", "CR", "XR"]
MEAS_UID_PATTERNS_A = [
    r"MeasUID[:\s=]+([A-Fa-f0-9\-]{8,64})",
    r'"MeasUID"\s*:\s*"([A-Fa-f0-9\-]+)"',
    r"(?i)MeasUID\s+([0-9a-fA-F]{16,64})",
]
MEAS_UID_PATTERNS_B = [
    r"(?i)MeasUID[:\s=]+([A-Fa-f0-9\-]{8,64})",
    r"(?i)Meas[_-]?UID[:\s=]+([A-Fa-f0-9\-]{8,64})",
    r'(?i)"MeasUID"\s*:\s*"([A-Fa-f0-9\-]+)"',
    r"(?i)MeasUID\s+([0-9a-fA-F]{16,64})",
]
SERIES_TEXT_PATTERNS_B = [
    r"(?i)Meas[_-]?UID[:\s=]+([A-Fa-f0-9\-]{8,64})",
    r"(?i)测量ID[:\s=]+([A-Fa-f0-9\-]{8,64})",
]

# --- fixed values: paths -----------------------------------------------------------------

MAX_COMPONENT = 48
MAX_PATH = 240
MAX_INPUT_PATH = 4096
MAX_UID = 64
DANGEROUS = ["//", "\\\\", "..", "~", "$"]
TRAVERSAL = r"\.\./|\.\.\\|^/|^\\"
CONTROL = r"[\x00-\x1f\x7f-\x{9f}]"
UID = r"^[0-9]+(\.[0-9]+)*$"
META_VALUE_LIMIT = 1024

# --- fixed values: archives --------------------------------------------------------------

ARCHIVE_LIMITS = {
    "max_total_bytes": 100 * 1024 * 1024,
    "max_entry_count": 10000,
    "max_nesting_depth": 3,
    "max_entry_bytes": 50 * 1024 * 1024,
}
ARCHIVE_RATIO = 100
ARCHIVE_RATIO_FLOOR = 1024 * 1024

# --- fixed values: private tags and sensitive fields -------------------------------------

TEXT_VRS = ["LO", "LT", "SH", "ST", "UT", "AE", "PN", "UI"]
MAX_RAW_VALUE = 65536
TRUNCATED = "<truncated>"
SENSITIVE_FIELDS = [
    "patient_name",
    "patient_id",
    "patient_birth_date",
    "patient_birth_time",
    "patient_sex",
    "patient_age",
    "patient_weight",
    "patient_address",
    "patient_phone",
    "patient_mothers_maiden_name",
    "patient_ssn",
    "patient_insurance",
    "referring_physician_name",
    "performing_physician_name",
    "operator_name",
    "physician_of_record",
    "study_description",
    "series_description",
    "raw_dicom_tags",
]
REDACTED = "[REDACTED-PHI]"
INTERNAL_KEYS = ["absolute_path", "_internal_absolute_path", "local_path"]
PLACEHOLDERS = ["UNKNOWN", "UNKNOWN_VENDOR", "UNKNOWN_DEVICE", "GENERIC", "NO_MEAS_UID"]
WHITESPACE = r"[\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"

# --- fixed values: references ------------------------------------------------------------

REFERENCE_SEQUENCES = {
    "ReferencedImageSequence": "referenced_image",
    "ReferencedInstanceSequence": "referenced_instance",
    "SourceInstanceSequence": "source_instance",
    "ReferencedStudySequence": "referenced_study",
    "ReferencedSeriesSequence": "referenced_series",
    "ReferencedImageNavigationSequence": "presentation",
    "ReferencedWaveformSequence": "waveform",
}
RELATIONSHIPS = list(REFERENCE_SEQUENCES.values())

# --- fixed values: conflicts, binding, projection, reindex -------------------------------

UID_CONFLICT_THRESHOLD = 0.10
SEVERITY = {
    "content_conflict": "critical",
    "uid_conflict": "critical",
    "partial_overlap": "warning",
    "exact_duplicate": "info",
}
SEVERITY_ORDER = ["critical", "warning", "info"]
RESOLUTIONS = {"keep_existing": "kept_existing", "promote_uploaded": "promoted_uploaded"}
BINDING_RETRY_STATES = ["failed", "deferred", "pending"]
MAX_BINDING_RETRIES = 5
PROJECTION_VERSION = "1.0.0"
EXTRACTOR_VERSION = "1.0.0"
SECONDS_PER_INSTANCE = 0.1
LARGE_SCOPE = 10000

# --- fixed values: metrics ---------------------------------------------------------------

STAGE_BUCKETS_MS = [10, 50, 100, 250, 500, 1000, 5000, 10000]
LAG_BUCKETS_S = [1, 5, 10, 30, 60, 120, 300, 600]
UID_TAGS = ["SOPInstanceUID", "StudyInstanceUID", "SeriesInstanceUID", "FrameOfReferenceUID"]

RECOVERY_BUCKETS_MS = [100, 500, 1000, 2500, 5000, 10000, 30000, 60000]
