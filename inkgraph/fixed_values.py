"""Fixed values.

Everything in this module is a given constant (labels, word lists, graph
constants, sample texts, field formats).  The values have to be exactly these
for results to come out right; nothing here is logic.
"""

# --- fixed values: object type tags of the JSON bundle -----------------------
TACTIC_TYPE = "x-mitre-tactic"
TECHNIQUE_TYPE = "attack-pattern"
GROUP_TYPE = "intrusion-set"
RELATIONSHIP_TYPE = "relationship"

# --- fixed values: text lengths ----------------------------------------------
DESCRIPTION_CHARS = 500
DETECTION_CHARS = 300
PREVIEW_CHARS = 200
ECHO_CHARS = 300

# --- fixed values: the ordered label list ------------------------------------
LABELS = [
    "Initial Access",
    "Execution",
    "Persistence",
    "Privilege Escalation",
    "Defense Evasion",
    "Credential Access",
    "Discovery",
    "Lateral Movement",
    "Collection",
    "Command and Control",
    "Exfiltration",
    "Impact",
    "Reconnaissance",
    "Resource Development",
]

# --- fixed values: keywords per label ----------------------------------------
KEYWORDS = {
    "Initial Access": [
        "phishing", "exploit", "drive-by", "supply chain", "external", "valid accounts",
        "replication", "hardware", "trusted relationship", "watering hole",
    ],
    "Execution": [
        "execute", "powershell", "command", "script", "run", "invoke", "shell", "macro",
        "wmi", "scheduled task", "api",
    ],
    "Persistence": [
        "persistence", "registry", "startup", "scheduled task", "service", "boot",
        "account", "implant", "backdoor",
    ],
    "Privilege Escalation": [
        "privilege", "escalation", "token", "impersonation", "sudo", "bypass",
        "administrator", "root", "uac",
    ],
    "Defense Evasion": [
        "evasion", "obfuscation", "disable", "antivirus", "log", "masquerade",
        "inject", "rootkit", "signed", "dll sideload",
    ],
    "Credential Access": [
        "credential", "password", "mimikatz", "dump", "keylog", "hash",
        "brute force", "kerberos", "lsass",
    ],
    "Discovery": [
        "discovery", "scan", "enumerate", "network", "account", "system", "nmap",
        "query", "file", "process",
    ],
    "Lateral Movement": [
        "lateral", "movement", "pass the hash", "remote", "smb", "rdp",
        "wmi", "ssh", "psexec",
    ],
    "Collection": [
        "collect", "clipboard", "capture", "screen", "keylog", "file", "email",
        "audio", "video",
    ],
    "Command and Control": [
        "c2", "c&c", "command", "control", "beacon", "dns tunnel",
        "encrypted", "covert", "backdoor",
    ],
    "Exfiltration": [
        "exfiltration", "upload", "transfer", "compress", "cloud", "ftp",
        "dns", "out", "steal", "exfil",
    ],
    "Impact": [
        "ransomware", "encrypt", "delete", "destroy", "disrupt", "deface",
        "wipe", "disable", "defacement", "shutdown",
    ],
    "Reconnaissance": [
        "reconnaissance", "gather", "osint", "scan", "phishing for info",
        "victim", "research",
    ],
    "Resource Development": [
        "infrastructure", "develop", "acquire", "compromise", "stage",
        "malware", "tool", "account",
    ],
}

# --- fixed values: names of cluster profiles ---------------------------------
PROFILE_NAMES = {
    0: "Advanced Persistent Threat (APT)",
    1: "Ransomware / Cybercrime Group",
    2: "Insider Threat Actor",
    3: "State-Sponsored ICS / OT Attacker",
}

# --- fixed values: graph nodes and their descriptions ------------------------
NODE_DESCRIPTIONS = {
    "Reconnaissance": "Gather information about the target environment",
    "Resource Development": "Acquire infrastructure, accounts, and tooling",
    "Initial Access": "Gain a foothold via phishing, exploits, or valid accounts",
    "Execution": "Run malicious code on the target system",
    "Persistence": "Maintain access across reboots and credential changes",
    "Privilege Escalation": "Gain higher-level permissions on the system",
    "Defense Evasion": "Avoid detection by security tools",
    "Credential Access": "Steal account credentials and hashes",
    "Discovery": "Enumerate the environment (hosts, users, shares)",
    "Lateral Movement": "Move through the network to additional systems",
    "Collection": "Gather data of interest for exfiltration",
    "Command and Control": "Communicate with compromised systems over C2 channels",
    "Exfiltration": "Transfer stolen data to adversary-controlled infrastructure",
    "Impact": "Disrupt, destroy, or manipulate business operations",
}

# --- fixed values: graph edges (source, target, weight) ----------------------
GRAPH_EDGES = [
    ("Reconnaissance", "Resource Development", 0.9),
    ("Resource Development", "Initial Access", 0.85),
    ("Initial Access", "Execution", 0.9),
    ("Execution", "Persistence", 0.8),
    ("Execution", "Privilege Escalation", 0.75),
    ("Persistence", "Defense Evasion", 0.7),
    ("Privilege Escalation", "Defense Evasion", 0.8),
    ("Defense Evasion", "Credential Access", 0.75),
    ("Credential Access", "Discovery", 0.85),
    ("Discovery", "Lateral Movement", 0.8),
    ("Lateral Movement", "Collection", 0.75),
    ("Lateral Movement", "Execution", 0.5),
    ("Collection", "Command and Control", 0.85),
    ("Command and Control", "Exfiltration", 0.8),
    ("Command and Control", "Impact", 0.6),
    ("Exfiltration", "Impact", 0.5),
]

# --- fixed values: weights and kinds of edges, default node type --------------
DEFAULT_WEIGHT = 0.5
MEMBER_WEIGHT = 0.4
MEMBER_EDGE = "intra_tactic"
CLASS_EDGE = "cross_tactic"
NODE_TYPE = "tactic"

# --- fixed values: members (id, name) of each graph class --------------------
CLASS_MEMBERS = {
    "Initial Access": [("T1566", "Phishing"), ("T1190", "Exploit Public-Facing App"), ("T1078", "Valid Accounts")],
    "Execution": [("T1059", "Command & Scripting Interpreter"), ("T1204", "User Execution"), ("T1053", "Scheduled Task")],
    "Persistence": [("T1547", "Boot/Logon Autostart"), ("T1543", "Create/Modify System Process"), ("T1136", "Create Account")],
    "Privilege Escalation": [("T1068", "Exploitation for Privilege Escalation"), ("T1055", "Process Injection"), ("T1134", "Access Token Manipulation")],
    "Defense Evasion": [("T1036", "Masquerading"), ("T1562", "Impair Defenses"), ("T1027", "Obfuscated Files")],
    "Credential Access": [("T1003", "OS Credential Dumping"), ("T1110", "Brute Force"), ("T1555", "Credentials from Password Stores")],
    "Discovery": [("T1082", "System Information Discovery"), ("T1046", "Network Service Discovery"), ("T1033", "System Owner/User Discovery")],
    "Lateral Movement": [("T1021", "Remote Services"), ("T1550", "Use Alternate Auth Material"), ("T1570", "Lateral Tool Transfer")],
    "Collection": [("T1005", "Data from Local System"), ("T1056", "Input Capture"), ("T1560", "Archive Collected Data")],
    "Command and Control": [("T1071", "Application Layer Protocol"), ("T1095", "Non-Application Layer Protocol"), ("T1572", "Protocol Tunneling")],
    "Exfiltration": [("T1048", "Exfiltration Over Alt Protocol"), ("T1041", "Exfiltration Over C2 Channel"), ("T1567", "Exfiltration Over Web Service")],
    "Impact": [("T1486", "Data Encrypted for Impact"), ("T1485", "Data Destruction"), ("T1489", "Service Stop")],
}

# --- fixed values: named scenarios (name, start, end, description) -----------
SCENARIOS = [
    ("APT Espionage Campaign", "Reconnaissance", "Exfiltration",
     "Nation-state actor targeting sensitive government data"),
    ("Ransomware Attack", "Initial Access", "Impact",
     "Financially motivated group deploying ransomware"),
    ("Insider Threat", "Execution", "Exfiltration",
     "Malicious insider with valid credentials"),
]

# --- fixed values: sample reports (id, title, text) --------------------------
SAMPLE_REPORTS = [
    (
        "RPT-001",
        "APT29 Cozy Bear Campaign Analysis",
        "The threat actor used spear-phishing emails with malicious attachments to gain initial "
        "access. After execution, the malware established persistence via scheduled tasks and "
        "registry run keys. Lateral movement was achieved using Pass-the-Hash and remote services. "
        "Data was exfiltrated over encrypted C2 channels using custom backdoors. The group leveraged "
        "PowerShell scripts for discovery and credential dumping using Mimikatz.",
    ),
    (
        "RPT-002",
        "Ransomware Intrusion – Financial Sector",
        "Attackers exploited a public-facing RDP vulnerability for initial access. Privilege "
        "escalation was performed via token impersonation. Ransomware was deployed after "
        "disabling antivirus via command-line tools. Shadow copies were deleted using vssadmin. "
        "Network scanning with nmap revealed additional targets inside the environment.",
    ),
    (
        "RPT-003",
        "Supply Chain Attack via Software Build System",
        "Adversaries compromised a software build pipeline to inject malicious code into signed "
        "binaries. The trojanized update was distributed to downstream customers. Once executed, "
        "the implant performed DNS tunneling for C2 communication, used DLL side-loading for "
        "defense evasion, and harvested credentials from browser stores.",
    ),
    (
        "RPT-004",
        "Insider Threat – Data Exfiltration",
        "An insider abused valid credentials to access sensitive file shares. Large volumes of "
        "data were compressed and uploaded to cloud storage. Logs were cleared to cover tracks. "
        "Keyloggers were installed on shared workstations. Clipboard data was captured to collect "
        "credentials from other users.",
    ),
    (
        "RPT-005",
        "OT/ICS Targeted Attack – Energy Sector",
        "Initial compromise via watering-hole attack on an industry forum. The attacker moved "
        "laterally into the OT network using stolen VPN credentials. SCADA systems were targeted "
        "with custom ICS malware. Modbus protocol manipulation was observed. The payload attempted "
        "to disable safety systems and trigger physical damage.",
    ),
]
