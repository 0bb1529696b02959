"""Presets: column roles and the fixed values the results depend on.

Operators never hard-code column names; they take a ``Roles`` / ``FeatureSpec``
(or plain arguments). ``PE_PRESET`` describes the executable-header table of
the original study; ``FIXTURE`` maps the same roles onto the driver tables.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# Fixed values (must equal the original study's for matching results)
# ---------------------------------------------------------------------------
SEED = 42
TEST_FRACTION = 0.20
CV_FOLDS = 10
N_WINDOWS = 5
CALIBRATION_TAIL = 0.15
CONFIDENCE_THRESHOLD = 0.65
RECENCY_ALPHA = 1.0
DECAY_PENALTY = 2.0
PSI_BUCKETS = 10
PSI_EPS = 1e-6
YEAR_MIN, YEAR_MAX = 1990, 2030
TREND_BAND = 0.02
RETRAIN_DROP = 0.05
ENTROPY_HIGH = 7.5
ENTROPY_LOW = 7.0
SECTIONS_HIGH = 10
DLL_MANY = 100
DLL_NORMAL_MAX = 50
DEMO_PREVALENCE, DEMO_SAMPLE = 0.10, 500

# Packer / protector substrings (case-sensitive).
PACKER_PATTERNS = (
    "UPX", "ACProtect", "ASPack", "PECompact", "MEW", "Themida",
    "VMProtect", "Armadillo", "FSG", "PEX", "Yoda", "Petite",
    "Enigma", "Obsidium", "MoleBox", "PELock",
)

# Imported API names counted as dangerous (exact match).
DANGEROUS_API_NAMES = (
    "WinExec", "CreateProcessA", "CreateProcessW",
    "VirtualAlloc", "VirtualAllocEx", "VirtualProtect",
    "WriteProcessMemory", "ReadProcessMemory",
    "LoadLibraryA", "LoadLibraryW", "LoadLibraryExA", "LoadLibraryExW",
    "GetProcAddress",
    "CreateRemoteThread", "NtCreateThreadEx",
    "OpenProcess", "TerminateProcess",
    "RegSetValueExA", "RegSetValueExW",
    "InternetOpenA", "InternetOpenUrlA", "URLDownloadToFileA",
    "CreateFileA", "CreateFileW",
    "ShellExecuteA", "ShellExecuteW",
    "CryptEncrypt", "CryptDecrypt",
)

# Column names of the executable-header table.
IDENTIFIER_COLUMNS = ("MD5", "SHA1", "Name", "Fuzzy")
NEAR_ZERO_VARIANCE_COLUMNS = ("Magic", "PE_TYPE", "SizeOfOptionalHeader")
RAW_NUMERIC_FEATURES = (
    "BaseOfCode", "BaseOfData", "Characteristics", "DllCharacteristics",
    "Entropy", "FileAlignment", "ImageBase", "Machine", "NumberOfRvaAndSizes",
    "NumberOfSections", "NumberOfSymbols", "PointerToSymbolTable", "Size",
    "SizeOfCode", "SizeOfHeaders", "SizeOfImage", "SizeOfInitializedData",
    "SizeOfUninitializedData", "TimeDateStamp",
)
STRING_FEATURE_SOURCES = ("ImportedDlls", "ImportedSymbols", "Identify", "FormatedTimeDateStamp")
ENGINEERED_FEATURES = (
    "n_imported_dlls", "n_imported_symbols", "identify_is_packed",
    "identify_signature_count", "formatted_timedatestamp_year",
    "imports_dangerous_api", "time_alignment_anomaly", "dll_count_anomaly",
)
FEATURE_COLUMNS = RAW_NUMERIC_FEATURES + ENGINEERED_FEATURES
# Heavy-tailed columns: impute -> log1p -> standardise; the rest: impute -> standardise.
LOG_THEN_SCALE = (
    "BaseOfCode", "BaseOfData", "ImageBase",
    "NumberOfRvaAndSizes", "NumberOfSymbols", "PointerToSymbolTable",
    "Size", "SizeOfCode", "SizeOfHeaders", "SizeOfImage",
    "SizeOfInitializedData", "SizeOfUninitializedData",
    "n_imported_dlls", "n_imported_symbols", "identify_signature_count",
)
# Model order of the headline table (names not listed are dropped).
HEADLINE_ORDER = (
    "logistic_regression", "decision_tree", "random_forest", "torch_mlp",
    "xgboost", "lightgbm", "catboost",
)

VERDICT_ALLOWED = "ALLOWED"
VERDICT_BLOCKED_MALWARE = "BLOCKED_MALWARE"
VERDICT_BLOCKED_UNCERTAIN = "BLOCKED_UNCERTAIN"


@dataclass(frozen=True)
class Roles:
    """Which column plays which part in a labelled, partly dated table."""
    id: str = "sample_id"
    label: str = "label"
    date: str = "sample_date"


@dataclass(frozen=True)
class FeatureSpec:
    """String sources and thresholds for the engineered features."""
    dlls: str = "ImportedDlls"
    symbols: str = "ImportedSymbols"
    identify: str = "Identify"
    timestamp: str = "FormatedTimeDateStamp"
    packer_patterns: tuple = PACKER_PATTERNS
    dangerous_names: tuple = DANGEROUS_API_NAMES
    year_min: int = YEAR_MIN
    year_max: int = YEAR_MAX
    dll_many: int = DLL_MANY
    timestamp_formats: tuple = (
        "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd",
        "yyyy/MM/dd HH:mm:ss", "yyyy/MM/dd", "dd MMM yyyy HH:mm:ss",
    )


@dataclass(frozen=True)
class RuleColumns:
    """Columns read by the explanation rules."""
    packed: str = "identify_is_packed"
    identify: str = "Identify"
    entropy: str = "Entropy"
    dangerous: str = "imports_dangerous_api"
    dll_anomaly: str = "dll_count_anomaly"
    n_dlls: str = "n_imported_dlls"
    time_anomaly: str = "time_alignment_anomaly"
    sections: str = "NumberOfSections"


@dataclass(frozen=True)
class Preset:
    roles: Roles = field(default_factory=Roles)
    features: FeatureSpec = field(default_factory=FeatureSpec)
    log_cols: tuple = LOG_THEN_SCALE
    scale_cols: tuple = tuple(c for c in FEATURE_COLUMNS if c not in LOG_THEN_SCALE)
    rules: RuleColumns = field(default_factory=RuleColumns)


PE_PRESET = Preset(roles=Roles(id="MD5", label="Label", date="__sample_date"))

# The driver tables in the same roles (see sources/fixtures.py).
FIXTURE_FEATURES = FeatureSpec(
    dlls="imported_dlls", symbols="imported_symbols", identify="identify",
    timestamp="formatted_ts",
    # the fixture's "packer" and "dangerous" vocabularies live in order
    # priorities and part brands
    packer_patterns=("URGENT", "HIGH"),
    dangerous_names=("Brand#1", "Brand#13", "Brand#22"),
)
FIXTURE_LOG_COLS = ("total_price", "sum_qty", "max_price", "n_imported_dlls",
                    "n_imported_symbols", "identify_signature_count")
FIXTURE_SCALE_COLS = ("cust_key", "n_lines", "max_discount", "max_tax", "entropy",
                      "identify_is_packed", "formatted_timedatestamp_year",
                      "imports_dangerous_api", "time_alignment_anomaly", "dll_count_anomaly")
FIXTURE_RULES = RuleColumns(identify="identify", entropy="entropy", sections="n_lines")
FIXTURE = Preset(roles=Roles(), features=FIXTURE_FEATURES, log_cols=FIXTURE_LOG_COLS,
                 scale_cols=FIXTURE_SCALE_COLS, rules=FIXTURE_RULES)
