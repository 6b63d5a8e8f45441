"""Lookup tables and rules whose values must match the published ones."""

from __future__ import annotations

# Attack name -> class, by attack family.
ATTACK_FAMILIES = {
    "normal": ["normal"],
    "ddos": [
        "back", "land", "neptune", "pod", "smurf", "teardrop", "mailbomb", "apache2",
        "processtable", "udpstorm", "worm",
    ],
    "port_scan": ["satan", "ipsweep", "nmap", "portsweep", "mscan", "saint"],
    "brute_force": [
        "guess_passwd", "ftp_write", "imap", "phf", "multihop", "warezclient", "warezmaster",
        "spy", "xlock", "xsnoop", "snmpguess", "snmpgetattack", "httptunnel", "sendmail", "named",
    ],
    "botnet": [
        "buffer_overflow", "loadmodule", "rootkit", "perl", "sqlattack", "xterm", "ps",
    ],
}

# Service name -> folded service.
SERVICE_FOLD = {
    "http": "http", "http_2784": "http", "http_8001": "http", "http_443": "https",
    "domain": "dns", "domain_u": "dns", "smtp": "smtp", "pop_2": "smtp", "pop_3": "smtp",
    "imap4": "smtp", "ssh": "ssh", "ftp": "ftp", "ftp_data": "ftp", "telnet": "ssh",
    "klogin": "ssh", "kshell": "ssh", "login": "ssh", "shell": "ssh", "netbios_ssn": "ssh",
}
SERVICE_DEFAULT = "other"

# Connection flag -> folded flag.
FLAG_FOLD = {
    "SF": "SF", "S0": "S0", "REJ": "REJ", "RSTO": "RSTO", "RSTR": "RSTO", "RSTOS0": "RSTO",
    "S1": "S0", "S2": "S0", "S3": "S0", "SH": "S0", "OTH": "SF",
}
FLAG_DEFAULT = "SF"

# Server port -> service.
PORT_SERVICE = {
    80: "http", 8080: "http", 8000: "http", 443: "https", 8443: "https", 53: "dns", 25: "smtp",
    587: "smtp", 465: "smtp", 22: "ssh", 21: "ftp", 20: "ftp",
}
PORT_DEFAULT = "other"

# Closed value ranges of the numeric features.
RANGES = {
    "duration": (0.0, 600.0),
    "src_bytes": (0.0, 5e6),
    "dst_bytes": (0.0, 5e6),
    "count": (0.0, 5000.0),
    "srv_count": (0.0, 5000.0),
    "same_srv_rate": (0.0, 1.0),
    "diff_srv_rate": (0.0, 1.0),
    "src_port_entropy": (0.0, 10.0),
    "packet_rate": (0.0, 50000.0),
    "connection_duration_std": (0.0, 1000.0),
    "failed_logins": (0.0, 1000.0),
    "bytes_per_packet": (0.0, 10000.0),
}
RANGE_FAIL_SHARE = 0.05

# The range rules applied after mapping external rows.
MAPPED_RANGES = [
    "duration", "src_bytes", "dst_bytes", "count", "srv_count", "packet_rate", "bytes_per_packet",
]

# Allowed categories.
DOMAINS = {
    "protocol": ["tcp", "udp", "icmp"],
    "service": ["http", "https", "dns", "smtp", "ssh", "ftp"],
    "flag": ["SF", "S0", "REJ", "RSTO"],
}
DOMAIN_DEFAULT = "other"

# Class balance thresholds.
MIN_BENIGN_SHARE = 0.10
RARE_CLASS_SHARE = 0.002

# Bulk record defaults (every numeric defaults to 0.0 and must be >= 0).
RECORD_TEXT_DEFAULTS = {"protocol": "tcp", "service": "http", "flag": "SF"}
RECORD_UNIT_INTERVAL = ["same_srv_rate", "diff_srv_rate"]

# TCP control bits.
TCP_FIN, TCP_SYN, TCP_RST = 0x01, 0x02, 0x04

# What-if shift clips for scaled benign columns.
SHIFT_CLIPS = {
    "src_bytes": (40.0, 2e6),
    "dst_bytes": (40.0, 2e6),
    "packet_rate": (1.0, 20000.0),
    "duration": (0.0, 300.0),
}
