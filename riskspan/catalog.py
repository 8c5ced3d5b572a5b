"""Fixed values that must equal the reference's for right results.

Everything below is data (lookup tables, word lists, field paths, thresholds),
stated plainly and in natural order.  Operators generate their Spark
expressions from these tables; nothing here is code.
"""

# ---------------------------------------------------------------------------
# FIXED VALUES: null tokens, ID pattern, severity thresholds
# ---------------------------------------------------------------------------
NULL_TOKENS = ["", "n/a", "None"]

CVE_ID_PATTERN = r"(?i)CVE-(1999|20[0-9]{2})-([0-9]{4,7})"

ENGLISH_TAGS = ["en", "eng", "english"]

# ---------------------------------------------------------------------------
# FIXED VALUES: CVSS vector metrics per version
# ---------------------------------------------------------------------------
CVSS_BASE_METRIC_NAMES = {
    "AV": "attack_vector",
    "AC": "attack_complexity",
    "PR": "privileges_required",
    "UI": "user_interaction",
    "S": "scope",
    "C": "confidentiality",
    "I": "integrity",
    "A": "availability",
    "E": "exploit_maturity",
    "RL": "remediation_level",
    "RC": "report_confidence",
    "CR": "confidentiality_requirement",
    "IR": "integrity_requirement",
    "AR": "availability_requirement",
}

CVSS_VERSION_METRIC_NAMES = {
    "v2": {
        "Au": "authentication",
        "CDP": "collateral_damage_potential",
        "TD": "target_distribution",
    },
    "v4": {
        "AT": "attack_requirements",
        "VC": "vuln_sys_confidentiality",
        "SC": "sub_sys_confidentiality",
        "VI": "vuln_sys_integrity",
        "SI": "sub_sys_integrity",
        "VA": "vuln_sys_availability",
        "SA": "sub_sys_availability",
        "S": "safety",
        "AU": "automatable",
        "R": "recovery",
        "V": "value_density",
        "RE": "response_effort",
        "U": "urgency",
    },
}

NPC = {"N": "NONE", "P": "PARTIAL", "C": "COMPLETE"}
# The shared N/L/M/H table has no LM or MH entries (so v2 CDP values LM/MH
# translate to null).
NLMH = {"N": "NONE", "L": "LOW", "M": "MEDIUM", "H": "HIGH",
        "ND": "NOT DEFINED", "X": "NOT DEFINED"}
EXPLOIT_V2V3 = {"ND": "NOT DEFINED", "X": "NOT DEFINED", "U": "UNPROVEN",
                "POC": "PROOF-OF-CONCEPT", "P": "PROOF-OF-CONCEPT",
                "F": "FUNCTIONAL", "H": "HIGH"}
REMEDIATION = {"ND": "NOT DEFINED", "X": "NOT DEFINED", "U": "UNAVAILABLE",
               "W": "WORKAROUND", "TF": "TEMPORARY FIX", "T": "TEMPORARY FIX",
               "OF": "OFFICIAL FIX", "O": "OFFICIAL FIX"}
LANP = {"L": "LOCAL", "A": "ADJACENT", "N": "NETWORK", "P": "PHYSICAL"}

CVSS_METRICS = {
    "v2": ["AV", "AC", "Au", "C", "I", "A", "E", "RL", "RC", "CDP", "TD",
           "CR", "IR", "AR"],
    "v3": ["AV", "AC", "PR", "UI", "S", "C", "I", "A", "E", "RL", "RC",
           "CR", "IR", "AR"],
    "v4": ["AV", "AC", "AT", "PR", "UI", "VC", "SC", "S", "AU", "V", "U",
           "VI", "SI", "VA", "SA", "E", "CR", "IR", "AR", "R", "RE"],
}

CVSS_TRANSLATIONS = {
    "v2": {
        "AV": LANP, "AC": NLMH,
        "Au": {"N": "NONE", "S": "SINGLE", "M": "MULTIPLE"},
        "C": NPC, "I": NPC, "A": NPC,
        "E": EXPLOIT_V2V3, "RL": REMEDIATION,
        "RC": {"UC": "UNCONFIRMED", "UR": "UNCORROBORATED", "C": "CONFIRMED",
               "ND": "NOT DEFINED"},
        "CDP": NLMH, "TD": NLMH, "CR": NLMH, "IR": NLMH, "AR": NLMH,
    },
    "v3": {
        "AV": LANP, "AC": NLMH, "PR": NLMH,
        "UI": {"N": "NONE", "R": "REQUIRED"},
        "S": {"U": "UNCHANGED", "C": "CHANGED"},
        "C": NLMH, "I": NLMH, "A": NLMH,
        "E": EXPLOIT_V2V3, "RL": REMEDIATION,
        "RC": {"X": "NOT DEFINED", "C": "CONFIRMED", "R": "REASONABLE",
               "U": "UNKNOWN"},
        "CR": NLMH, "IR": NLMH, "AR": NLMH,
    },
    "v4": {
        "AV": LANP, "AC": NLMH,
        "AT": {"N": "NONE", "P": "PRESENT"},
        "PR": NLMH,
        "UI": {"N": "NONE", "P": "PASSIVE", "A": "ACTIVE"},
        "VC": NLMH, "SC": NLMH, "VI": NLMH, "SI": NLMH, "VA": NLMH, "SA": NLMH,
        "E": {"X": "NOT DEFINED", "A": "ATTACKED", "P": "PROOF-OF-CONCEPT",
              "U": "UNREPORTED"},
        "CR": NLMH, "IR": NLMH, "AR": NLMH,
        "S": {"X": "NOT DEFINED", "P": "PRESENT", "N": "NEGLIGIBLE"},
        "AU": {"X": "NOT DEFINED", "N": "NO", "Y": "YES"},
        "U": {"X": "NOT DEFINED", "Red": "RED", "Amber": "AMBER",
              "Green": "GREEN", "Clear": "CLEAR"},
        "R": {"X": "NOT DEFINED", "A": "AUTOMATIC", "U": "USER",
              "I": "IRRECOVERABLE"},
        "V": {"X": "NOT DEFINED", "D": "DIFFUSE", "C": "CONCENTRATED"},
        "RE": NLMH,
    },
}

# FIXED VALUES: Unified metric <- version columns, lowest to highest priority (last
# non-null wins).
CVSS_COMPILE_MAP = {
    "attack_complexity": ["attack_complexity_v2", "attack_complexity_v3",
                          "attack_complexity_v4"],
    "attack_requirements": ["attack_requirements_v4"],
    "attack_vector": ["attack_vector_v2", "attack_vector_v3",
                      "attack_vector_v4"],
    "authentication": ["authentication_v2"],
    "automatable": ["automatable_v4"],
    "availability": ["availability_v2", "availability_v3",
                     "vuln_sys_availability_v4"],
    "availability_requirement": ["availability_requirement_v2",
                                 "availability_requirement_v3",
                                 "availability_requirement_v4"],
    "confidentiality": ["confidentiality_v2", "confidentiality_v3",
                        "vuln_sys_confidentiality_v4"],
    "confidentiality_requirement": ["confidentiality_requirement_v2",
                                    "confidentiality_requirement_v3",
                                    "confidentiality_requirement_v4"],
    "cvss": ["cvss_v2", "cvss_v3", "cvss_v4"],
    "cvss_severity": ["cvss_v2_severity", "cvss_v3_severity",
                      "cvss_v4_severity"],
    "exploit_maturity": ["exploit_maturity_v3", "exploit_maturity_v4"],
    "integrity": ["integrity_v2", "integrity_v3", "vuln_sys_integrity_v4"],
    "integrity_requirement": ["integrity_requirement_v2",
                              "integrity_requirement_v3",
                              "integrity_requirement_v4"],
    "privileges_required": ["privileges_required_v3", "privileges_required_v4"],
    "recovery": ["recovery_v4"],
    "remediation_level": ["remediation_level_v3"],
    "report_confidence": ["report_confidence_v3"],
    "response_effort": ["response_effort_v4"],
    "safety": ["safety_v4"],
    "scope": ["scope_v3"],
    "sub_sys_availability": ["sub_sys_availability_v4"],
    "sub_sys_confidentiality": ["sub_sys_confidentiality_v4"],
    "sub_sys_integrity": ["sub_sys_integrity_v4"],
    "urgency": ["urgency_v4"],
    "user_interaction": ["user_interaction_v3", "user_interaction_v4"],
    "value_density": ["value_density_v4"],
}

# ---------------------------------------------------------------------------
# FIXED VALUES: category standardization maps (keys are looked up with
# lower(cell), so mixed-case keys never match -- kept as in the source data
# contract)
# ---------------------------------------------------------------------------
CVE_CATEGORY_MAP = {
    "cve_discovery": {"external": "EXTERNAL", "internal": "INTERNAL",
                      "discovery statement": "Discovery Statement"},
    "ssvc_exploitation": {"none": "NONE", "poc": "POC", "PoC": "POC",
                          "active": "ACTIVE", "Active": "ACTIVE"},
    "ssvc_automatable": {"no": "NO", "No": "NO", "yes": "YES", "Yes": "YES"},
    "ssvc_tech_impact": {"partial": "PARTIAL", "Partial": "PARTIAL",
                         "total": "TOTAL", "Total": "TOTAL"},
    "cvss_v2_severity": {"Low": "LOW", "Medium": "MEDIUM", "High": "HIGH"},
    "cvss_v3_severity": {"None": "NONE", "Low": "LOW", "Medium": "MEDIUM",
                         "High": "HIGH", "Critical": "CRITICAL"},
    "cvss_v4_severity": {"None": "NONE", "Low": "LOW", "Medium": "MEDIUM",
                         "High": "HIGH", "Critical": "CRITICAL"},
}

NVD_VERSION_LABELS = {"2.0": "V2", "3.0": "V3", "3.1": "V3.1", "4.0": "V4"}

# ---------------------------------------------------------------------------
# FIXED VALUES: ICS/SCADA keyword lists.  Two entries of the source list were
# fused by missing commas ('remote telemetry unit' + 'remote terminal unit',
# 'IEC 61850' + 'IEC 101'); they are listed separately here.
# ---------------------------------------------------------------------------
CASE_SENSITIVE_KEYWORDS = [
    "ED SCADA",
    "EMS",
    "ICS",
    "PLC",
    "HDLC",
    "OPC",
    "OPC UA",
    "T101",
    "ABB",
    "GE",
]

CASE_INSENSITIVE_KEYWORDS = [
    "advanced metering",
    "advanced metering infrastructure",
    "automation of distribution networks",
    "electric distribution SCADA",
    "energy distribution",
    "grid automation",
    "grid monitoring",
    "industrial automation",
    "realtime monitoring",
    "real-time monitoring",
    "real time monitoring",
    "supervisory control and data acquisition",
    "SCADA",
    "substation automation",
    "transmission and distribution",
    "T&D",
    "critical infrastructure",
    "cyber-physical system",
    "cyber physical system",
    "distribution management system",
    "energy management system",
    "electric power grid",
    "electric power system",
    "industrial control system",
    "master station",
    "power system",
    "power grid",
    "power protection system",
    "power control",
    "programmable logic controller",
    "protection and control system",
    "remote telemetry unit",
    "remote terminal unit",
    "remote terminal",
    "remote telemetry",
    "smart grid",
    "smart meter",
    "DNP3",
    "IEC 60870",
    "IEC 60870-5-1",
    "IEC 60870-5-2",
    "IEC 60870-5-3",
    "IEC 60870-5-4",
    "IEC 60870-5-5",
    "IEC 60870-5-101",
    "IEC 61850",
    "IEC 101",
    "IEC 104",
    "IEC60870",
    "IEC60870-5",
    "IEC60870-5-1",
    "IEC60870-5-2",
    "IEC60870-5-3",
    "IEC60870-5-4",
    "IEC60870-5-5",
    "IEC60870-5-101",
    "IEC61850",
    "IEC101",
    "IEC104",
    "high level data link control",
    "modbus",
    "emerson",
    "GE digital energy",
    "general electric",
    "honeywell",
    "rockwell",
    "rockwell automation",
    "schneider",
    "siemens",
]

# ---------------------------------------------------------------------------
# FIXED VALUES: CVE record fields (output column -> dotted search path, where
# each path step may sit at any depth below the previous one)
# ---------------------------------------------------------------------------
CVE_FIELD_PATHS = {
    "cve_id": "cveMetadata.cveId",
    "cve_desc": "cna.descriptions.value",
    "cve_state": "cveMetadata.state",
    "mitre_cve_res_date": "cveMetadata.dateReserved",
    "mitre_cve_publish_date": "cveMetadata.datePublished",
    "mitre_cve_public_date": "containers.cna.datePublic",
    "cwe_id": "problemTypes.descriptions.cweId",
    "cwe_desc": "cna.problemTypes.descriptions",
    "vendor": "cna.affected.vendor",
    "product": "cna.affected.product",
    "prod_status": "cna.affected.versions.status",
    "prod_defaultStatus": "cna.affected.defaultStatus",
    "prod_version": "cna.affected.versions.version",
    "prod_version_type": "adp.affected.versions.versionType",
    "prod_lessThan": "adp.affected.versions.lessThan",
    "prod_lessThanOrEqual": "adp.affected.versions.lessThanOrEqual",
    "solution": "cna.solutions.value",
    "cve_discovery": "cna.source.discovery",
    "cpe": "adp.affected.cpes",
    "cvss_v2": "cna.metrics.cvssV2_0.baseScore",
    "cvss_v2_vector": "cna.metrics.cvssV2_0.vectorString",
    "cvss_v3": "cna.metrics.cvssV3_0.baseScore",
    "cvss_v3_vector": "cna.metrics.cvssV3_0.vectorString",
    "cvss_v3_1": "cna.metrics.cvssV3_1.baseScore",
    "cvss_v3_1_vector": "cna.metrics.cvssV3_1.vectorString",
    "cvss_v4": "cna.metrics.cvssV4_0.baseScore",
    "cvss_v4_vector": "cna.metrics.cvssV4_0.vectorString",
    "ssvc_exploitation": "content.options.Exploitation",
    "ssvc_automatable": "content.options.Automatable",
    "ssvc_tech_impact": "content.options.Technical Impact",
    "is_kev": "metrics.other.type",
}

# FIXED VALUES: PoC listing fields (output column -> key searched in each listing item)
POC_FIELDS = {
    "cve_id": "name",
    "poc_creation": "created_at",
    "poc_uploaded": "pushed_at",
    "poc_forks": "forks_count",
    "poc_visibility": "visibility",
    "poc_topics": "topics",
}

# FIXED VALUES: KEV catalogue column renames
KEV_RENAMES = {
    "cveID": "cve_id",
    "vendorProject": "vendor",
    "vulnerabilityName": "cve_name",
    "dateAdded": "kev_date_published",
    "shortDescription": "cve_short_desc",
    "requiredAction": "required_action",
    "dueDate": "due_date",
    "knownRansomwareCampaignUse": "known_use",
    "cwes": "cwe_id",
}

# FIXED VALUES: Ordered output of the compiled dataset
COMPILED_COLUMNS = [
    "cve_id", "date_public", "origin",
    "cvss", "cvss_severity", "cvss_src",
    "poc_code", "verified",
    "exploit_count", "days_to_poc_exploit",
    "first_poc_type", "first_poc_platform", "first_poc_port",
    "exploitation_date_0", "epss_0", "percentile_0",
    "exploitation_date_30", "epss_30", "percentile_30",
    "exploitation_date_60", "epss_60", "percentile_60",
    "change_0_to_30", "change_30_to_60", "change_0_to_60",
]

# FIXED VALUES: Score-history lookups start on this day (UTC)
SCORE_ERA_START = "2021-04-14"
SCORE_OFFSETS = [0, 30, 60]

# FIXED VALUES: Anderson-Darling: significance levels (%) and Stephens' normal-case
# critical-value coefficients, scaled by 1 / (1 + 4/n - 25/n^2)
AD_SIGNIFICANCE = [15.0, 10.0, 5.0, 2.5, 1.0]
AD_CRITICAL_BASE = [0.576, 0.656, 0.787, 0.918, 1.092]

# FIXED VALUES: Right-closed score bins used by the synthetic-data check
SCORE_BIN_EDGES = [0, 4, 7, 9, 10]

# FIXED VALUES: accepted names of column types
TYPE_ALIASES = {
    "string": "string", "str": "string", "s": "string", "txt": "string", "text": "string",
    "integer": "long", "int": "long", "i": "long", "int64": "long", "num": "long",
    "numeric": "long", "number": "long",
    "float": "double", "f": "double", "double": "double", "dbl": "double",
    "datetime": "timestamp", "dt": "timestamp", "date": "timestamp",
    "timestamp": "timestamp", "time": "timestamp",
    "boolean": "boolean", "bool": "boolean", "b": "boolean",
    "categorical": "category", "category": "category", "cat": "category", "c": "category",
    "object": "object", "obj": "object", "o": "object",
}

# FIXED VALUES: severity of a score by CVSS version (label, lowest, highest)
SEVERITY_BANDS = {
    "v2": [("Low", 0.0, 3.9), ("Medium", 4.0, 6.9), ("High", 7.0, 10.0)],
    "v3": [("None", 0.0, 0.0), ("Low", 0.1, 3.9), ("Medium", 4.0, 6.9), ("High", 7.0, 8.9), ("Critical", 9.0, 10.0)],
}

# FIXED VALUES: score columns and the version that their severity follows
SEVERITY_VERSION = {"cvss_v2": "v2", "cvss_v3": "v3", "cvss_v3_1": "v3", "cvss_v4": "v3"}

# FIXED VALUES: final severity (label, lowest score)
FINAL_SEVERITY = [("CRITICAL", 9.0), ("HIGH", 7.0), ("MEDIUM", 4.0)]

# FIXED VALUES: order of patch urgencies
URGENCY_LEVELS = {"High": 3, "Medium": 2, "Low": 1}

# FIXED VALUES: subtables of the CVE records (name -> list columns beside cve_id)
CVE_SUBTABLES = {
    "cve_cwe_connection": ["cwe_id", "cwe_desc"],
    "cve_product": ["vendor", "product", "prod_status", "prod_defaultStatus", "prod_version", "prod_version_type",
                    "prod_lessThan", "prod_lessThanOrEqual", "cpe"],
}

# FIXED VALUES: column types of the weakness subtables; the label that platform rows carry
CWE_SUBTABLE_TYPES = {
    "related cwe table": {"string": ["cwe_id", "cwe_related_id"], "category": ["cwe_nature_of_rel", "source_table"]},
    "cwe consequence table": {"string": ["cwe_id", "cwe_consequence_scope", "cwe_consequence_impact", "cwe_consequence_note"],
                              "category": ["source_table"]},
    "cwe detection table": {"string": ["cwe_id", "cwe_detect_desc", "cwe_detect_effect_notes"],
                            "category": ["cwe_detect_method", "cwe_detect_effectiveness", "source_table"]},
    "cwe mitigation table": {"string": ["cwe_id", "cwe_miti_desc", "cwe_miti_effect_notes"],
                             "category": ["cwe_miti_phase", "cwe_miti_effect", "source_table"]},
    "cwe platform table": {"string": ["cwe_id"], "category": ["type", "name", "class", "prevalence", "source_table"]},
}
CWE_PLATFORM_SOURCE = "related_cwe_table"

# FIXED VALUES: column types of the cleaned tables, and list columns of which the first item counts
CVE_TYPES = {
    "string": ["cve_id", "cve_desc", "solution", "cvss_v2_vector", "cvss_v3_vector", "cvss_v4_vector"],
    "float": ["cvss"],
    "datetime": ["mitre_cve_res_date", "public_date"],
    "boolean": ["kev"],
}

CVE_FIRST_ITEM = ["cve_id", "cve_desc", "cve_state", "cve_discovery",
                  "ssvc_exploitation", "ssvc_automatable", "ssvc_tech_impact"]

NVD_TYPES = {"string": ["cve_id", "cvss_vector"], "datetime": ["date_published"],
             "float": ["cvss"], "category": ["cvss_src"]}

KEV_TYPES = {"string": ["cve_id", "vendor", "product", "cve_name", "cve_short_desc",
                        "required_action", "notes"],
             "datetime": ["kev_date_published", "due_date"], "category": ["known_use"]}

POC_TYPES = {"string": ["cve_id"], "integer": ["exploit_count", "poc_forks"],
             "datetime": ["earliest_date"], "category": ["poc_visibility"]}

# FIXED VALUES: ICS advisory column renames
ICS_RENAMES = {"cve_description": "cve_desc", "u_sys_created": "advisory_date", "u_sfp_cluster": "sfp_id",
               "u_old_cat": "cwe_name", "u_new_cat": "new_cwe_cat", "u_other_cat": "impossible_to_cat_cwes",
               "u_product_type": "product_type"}

# FIXED VALUES: version that a CVSS column name stands for
CVSS_COLUMN_VERSIONS = {"v2": "V2", "v3": "V3", "v3_1": "V3_1", "v4": "V4"}
