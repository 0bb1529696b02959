"""Rule-based explanation of every verdict.

The rules are data (predicate, text when allowed, text when blocked) turned
into one projection: ``array_compact(array(when(...)))`` for the evidence,
a flattened, de-duplicated technique list, fixed action lists and a
formatted summary. No per-row Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.config import (CONFIDENCE_THRESHOLD, DLL_NORMAL_MAX, ENTROPY_HIGH, ENTROPY_LOW, SECTIONS_HIGH,
                             VERDICT_ALLOWED, VERDICT_BLOCKED_MALWARE, VERDICT_BLOCKED_UNCERTAIN, RuleColumns)

# ---------------------------------------------------------------------------
# Evidence wording, technique mapping and recommended actions.
# ---------------------------------------------------------------------------
TXT_PACKED_ALLOWED = ("File is packed (Identify: {identify}), but the import set and section structure match a "
                      "legitimate packer signature — the model recognized this as benign packing, not malicious "
                      "obfuscation.")
TXT_PACKED_BLOCKED = ("File is **packed or obfuscated** (entropy / signature scan detected a known packer like UPX, "
                      "ACProtect, or similar).")
TXT_ENTROPY_ALLOWED = ("File entropy is **{entropy}** — high, but typical of installer self-extractors and compressed "
                       "legitimate binaries; the model did not flag the broader feature pattern as malicious.")
TXT_ENTROPY_BLOCKED = "File entropy is **{entropy}** — very high; consistent with packed or encrypted content."
TXT_API_ALLOWED = ("Imports include some commonly-monitored Windows APIs (file/process/memory primitives such as "
                   "`LoadLibraryA` or `VirtualAlloc`). These are dual-use — also routinely used by legitimate "
                   "installers and runtime loaders. The model evaluated the full call surface and did not flag it "
                   "as malicious.")
TXT_API_BLOCKED = ("Imports include high-risk Windows APIs (e.g., `LoadLibraryA`, `VirtualAlloc`, "
                   "`WriteProcessMemory`, `WinExec`) — these are the building blocks of process injection and remote "
                   "code execution.")
TXT_ZERO_DLL_ALLOWED = ("Zero imported DLLs — unusual but observed in statically-linked legitimate utilities; the "
                        "model classified the broader pattern as benign.")
TXT_ZERO_DLL_BLOCKED = ("Zero imported DLLs — unusual for a benign Windows binary; common in statically-linked "
                        "packers and dropped payloads.")
TXT_MANY_DLL_ALLOWED = ("Imports {n_dlls} DLLs — large import surface, but consistent with the profile of legitimate "
                        "complex applications (multi-component installers, IDEs, etc.).")
TXT_MANY_DLL_BLOCKED = "Imports {n_dlls} DLLs — unusually large surface; common in droppers and multi-stage loaders."
TXT_TIME_ALLOWED = ("PE compile timestamp is unusual, but the model did not flag the surrounding feature pattern as "
                    "malicious — likely an old or recompiled legitimate binary.")
TXT_TIME_BLOCKED = ("PE compile timestamp is missing or implausible (timestomping is a known anti-forensics "
                    "technique — MITRE T1070.006).")
TXT_SECTIONS_ALLOWED = ("Binary has {sections} sections — above the typical 4–6, but the model classified the layout "
                        "as legitimate.")
TXT_SECTIONS_BLOCKED = ("Binary has **{sections} sections** — well above the typical 4–6; multi-stage unpackers "
                        "commonly produce this pattern.")
TXT_POS_ENTROPY = "low entropy ({entropy}) — typical of unpacked, uncompressed legitimate binaries"
TXT_POS_DLLS = "{n_dlls} imported DLL{plural} — within the normal import-surface range"
TXT_POS_CLEAN = "no high-risk API combination, no packer signature, no PE structural anomalies"
TXT_DRIVEN = "Decision driven by the ensemble's calibrated probability ({p}) and joint confidence ({c})."
TXT_NO_DOMINANT = "No single feature dominates the verdict. " + TXT_DRIVEN

# trigger -> techniques, in trigger order
TECHNIQUES = (
    ("imports_dangerous_api", (("T1055", "Process Injection"), ("T1106", "Native API"))),
    ("identify_is_packed", (("T1027.002", "Software Packing"), ("T1027", "Obfuscated Files or Information"))),
    ("high_entropy", (("T1027", "Obfuscated Files or Information"),
                      ("T1140", "Deobfuscate/Decode Files or Information"))),
    ("time_alignment_anomaly", (("T1070.006", "Timestomp"),)),
    ("dll_count_anomaly", (("T1129", "Shared Modules (anomalous import surface)"),)),
)

ACTIONS = {
    VERDICT_BLOCKED_MALWARE: (
        "Isolate the source host from the network (disable its network interfaces or move it to a quarantine VLAN).",
        "Capture process and network telemetry from the source host *before* rebooting — running malware is more "
        "informative than dormant.",
        "Hash the file (SHA-256) and search VirusTotal / Hybrid Analysis for known indicators.",
        "Check email gateway logs for similar attachments delivered in the last 24 hours; the attacker likely didn't "
        "target only one mailbox.",
        "Open an IR ticket and notify the on-call security lead.",
    ),
    VERDICT_BLOCKED_UNCERTAIN: (
        "File is BLOCKED pending review — it does not enter the protected environment until a human approves it.",
        "Re-scan in 24 hours: the ensemble's next retraining cycle may resolve the uncertainty.",
        "If the file is business-critical and time-sensitive, perform manual analysis (sandbox detonation or "
        "VirusTotal lookup) before overriding.",
        "Do NOT override the block based solely on user pressure — uncertain verdicts on novel families are exactly "
        "the cases where blocking is the right default.",
    ),
    VERDICT_ALLOWED: (
        "File is allowed. No further action required.",
        "If you have independent reason to suspect this file (unusual sender, context, etc.), submit it for manual "
        "review.",
    ),
}

SUMMARY_BLOCKED = ("{system} classifies this file as **malware** with probability {p0} and joint confidence {c0}. "
                   "The file has been blocked and quarantined.")
SUMMARY_UNCERTAIN = ("{system} could not commit to an allow decision (probability {p0}, joint confidence {c0}, below "
                     "the {t0} threshold). Following zero-trust failure semantics, the file is blocked pending human "
                     "review.")
SUMMARY_ALLOWED = ("{system} classifies this file as **benign** with goodware probability {g0} (malware probability "
                   "{p2}) and joint confidence {c0}. The file is allowed.")


def _fill(template: str, **parts: Column) -> Column:
    """Template with {name} slots -> concat of literals and column pieces."""
    out, rest = [], template
    while "{" in rest:
        i = rest.index("{")
        j = rest.index("}", i)
        out.append(F.lit(rest[:i]))
        out.append(parts[rest[i + 1:j]])
        rest = rest[j + 1:]
    out.append(F.lit(rest))
    return F.concat(*out)


def _num(c: str | Column) -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(0))


def evidence(rc: RuleColumns = RuleColumns(), verdict: str = "verdict", prob: str = "probability",
             conf: str = "confidence") -> Column:
    """Ordered evidence bullets (array<string>)."""
    allowed = F.col(verdict) == VERDICT_ALLOWED
    packed, ent = _num(rc.packed) == 1, _num(rc.entropy).cast("double")
    n_dlls, sections = _num(rc.n_dlls), _num(rc.sections)
    e2 = F.format_string("%.2f", ent)
    pick = lambda a, b: F.when(allowed, a).otherwise(b)
    rules = [
        F.when(packed, pick(_fill(TXT_PACKED_ALLOWED, identify=F.coalesce(F.col(rc.identify), F.lit("None"))),
                            F.lit(TXT_PACKED_BLOCKED)))
         .when(ent >= ENTROPY_HIGH, pick(_fill(TXT_ENTROPY_ALLOWED, entropy=e2), _fill(TXT_ENTROPY_BLOCKED, entropy=e2))),
        F.when(_num(rc.dangerous) == 1, pick(F.lit(TXT_API_ALLOWED), F.lit(TXT_API_BLOCKED))),
        F.when(_num(rc.dll_anomaly) == 1, F.when(n_dlls == 0, pick(F.lit(TXT_ZERO_DLL_ALLOWED), F.lit(TXT_ZERO_DLL_BLOCKED)))
               .otherwise(pick(_fill(TXT_MANY_DLL_ALLOWED, n_dlls=n_dlls.cast("string")),
                               _fill(TXT_MANY_DLL_BLOCKED, n_dlls=n_dlls.cast("string"))))),
        F.when(_num(rc.time_anomaly) == 1, pick(F.lit(TXT_TIME_ALLOWED), F.lit(TXT_TIME_BLOCKED))),
        F.when(sections >= SECTIONS_HIGH, pick(_fill(TXT_SECTIONS_ALLOWED, sections=sections.cast("string")),
                                               _fill(TXT_SECTIONS_BLOCKED, sections=sections.cast("string")))),
    ]
    fired = F.array_compact(F.array(*rules))
    p2, c2 = F.format_string("%.2f", F.col(prob)), F.format_string("%.2f", F.col(conf))
    positives = F.array_compact(F.array(
        F.when((ent > 0) & (ent < ENTROPY_LOW), _fill(TXT_POS_ENTROPY, entropy=e2)),
        F.when((n_dlls >= 1) & (n_dlls <= DLL_NORMAL_MAX),
               _fill(TXT_POS_DLLS, n_dlls=n_dlls.cast("string"),
                     plural=F.when(n_dlls != 1, F.lit("s")).otherwise(F.lit("")))),
        F.lit(TXT_POS_CLEAN)))
    fallback = F.when(allowed, F.array(F.concat(F.lit("Positive evidence: "), F.array_join(positives, "; "), F.lit(".")),
                                       _fill(TXT_DRIVEN, p=p2, c=c2))) \
        .otherwise(F.array(_fill(TXT_NO_DOMINANT, p=p2, c=c2)))
    return F.when(F.size(fired) > 0, fired).otherwise(fallback)


def techniques(rc: RuleColumns = RuleColumns(), verdict: str = "verdict") -> Column:
    """X2 + X3: (id, name) structs in trigger order, de-duplicated keeping
    the first; empty for ALLOWED."""
    trig = {
        "imports_dangerous_api": _num(rc.dangerous) == 1,
        "identify_is_packed": _num(rc.packed) == 1,
        "high_entropy": _num(rc.entropy) >= ENTROPY_HIGH,
        "time_alignment_anomaly": _num(rc.time_anomaly) == 1,
        "dll_count_anomaly": _num(rc.dll_anomaly) == 1,
    }
    empty = F.array().cast("array<struct<id:string,name:string>>")
    parts = [F.when(trig[name], F.array(*[F.struct(F.lit(i).alias("id"), F.lit(n).alias("name")) for i, n in techs]))
             .otherwise(empty) for name, techs in TECHNIQUES]
    matched = F.array_distinct(F.flatten(F.array(*parts)))
    return F.when(F.col(verdict) == VERDICT_ALLOWED, empty).otherwise(matched)


def actions(verdict: str = "verdict") -> Column:
    """The fixed action list of the verdict."""
    v = F.col(verdict)
    arr = lambda items: F.array(*[F.lit(x) for x in items])
    return (F.when(v == VERDICT_BLOCKED_MALWARE, arr(ACTIONS[VERDICT_BLOCKED_MALWARE]))
            .when(v == VERDICT_BLOCKED_UNCERTAIN, arr(ACTIONS[VERDICT_BLOCKED_UNCERTAIN]))
            .otherwise(arr(ACTIONS[VERDICT_ALLOWED])))


def summary(verdict: str = "verdict", prob: str = "probability", conf: str = "confidence",
            system: str = "The ensemble", threshold: float = CONFIDENCE_THRESHOLD) -> Column:
    """One-paragraph summary with percentages."""
    p, c = F.col(prob), F.col(conf)
    pct0 = lambda x: F.format_string("%.0f%%", x * 100)
    sysl = F.lit(system)
    return (F.when(F.col(verdict) == VERDICT_BLOCKED_MALWARE, _fill(SUMMARY_BLOCKED, system=sysl, p0=pct0(p), c0=pct0(c)))
            .when(F.col(verdict) == VERDICT_BLOCKED_UNCERTAIN,
                  _fill(SUMMARY_UNCERTAIN, system=sysl, p0=pct0(p), c0=pct0(c), t0=pct0(F.lit(threshold))))
            .otherwise(_fill(SUMMARY_ALLOWED, system=sysl, g0=pct0(1 - p),
                             p2=F.format_string("%.2f%%", p * 100), c0=pct0(c))))


def explain(df: DataFrame, rc: RuleColumns = RuleColumns(), system: str = "The ensemble") -> DataFrame:
    """Adds ``report`` = struct(summary, why, techniques, actions, backend)."""
    return df.withColumn("report", F.struct(
        summary(system=system).alias("summary"), evidence(rc).alias("why"),
        techniques(rc).alias("attack_techniques"), actions().alias("recommended_actions"),
        F.lit("template").alias("backend")))
