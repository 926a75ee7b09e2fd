"""Media columns: payloads stored as MPEG-2 transport streams and read back.

:func:`store_streams` writes each payload as the elementary stream of a one-programme transport stream
(ISO/IEC 13818-1): programme association and map tables with their CRCs, PES packets with
presentation time stamps, programme clock references, random-access flags and continuity counters.
:func:`read_streams` parses any such column: it follows the tables, whose sections may span packets, to every
elementary stream, checks the continuity counters, takes repeated packets once, reassembles the PES packets, of
stated or unbounded length, and returns the payloads, the time stamps and the random-access points. Both are maps
without a shuffle; a task holds a slice of rows at a time.

Null payloads count as empty. Each row stands for itself: repeated rows give equal results, an empty table gives none,
and other columns, whatever their names, aren't read. A payload must be a whole number of units of 576 samples of 8 bits, which
:func:`unit_payload` makes of any text. A stream that isn't one gives a null payload and an ``error``.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_column

# Fixed values of the format (ISO/IEC 13818-1) and of the layout chosen here.
PACKET = 188
SYNC = 0x47
PAT_PID, PMT_PID, ES_PID = 0x0000, 0x0100, 0x0101
STREAM_TYPE = 0x06  # PES packets with private data
STREAM_ID = 0xBD  # private stream 1
UNIT = 576  # samples of 8 bits in one unit
TICKS = 1080  # 90 kHz clock ticks of a unit at 48,000 samples a second
UNITS_PER_PES = 8
PES_PER_ACCESS = 16  # tables and a random-access point come once in so many PES packets
PES_HEADER = 14


def unit_payload(text: Column) -> Column:
    """UTF-8 bytes of a text, filled up with bytes 255 to a positive multiple of 576 (null: empty)."""
    raw = F.encode(F.coalesce(text, F.lit("")), "UTF-8")
    size = F.octet_length(raw)
    fill = F.when(size == 0, F.lit(UNIT)).otherwise(F.pmod(-size, F.lit(UNIT)))
    return F.concat(raw, F.unhex(F.repeat(F.lit("FF"), fill)))


def _crc_table() -> np.ndarray:
    out = np.zeros(256, np.uint32)
    for i in range(256):
        c = i << 24
        for _ in range(8):
            c = ((c << 1) ^ 0x04C11DB7) & 0xFFFFFFFF if c & 0x80000000 else (c << 1) & 0xFFFFFFFF
        out[i] = c
    return out


_CRC = _crc_table().tolist()


def crc_mpeg(data: bytes) -> int:
    """CRC-32 as table sections carry it: polynomial 04C11DB7, not reflected, no final complement."""
    c = 0xFFFFFFFF
    for b in data:
        c = ((c << 8) & 0xFFFFFFFF) ^ _CRC[(c >> 24) ^ b]
    return c


def _section(table_id: int, ident: int, body: bytes) -> bytes:
    length = 5 + len(body) + 4
    head = bytes([table_id, 0xB0 | length >> 8, length & 255, ident >> 8, ident & 255, 0xC1, 0, 0]) + body
    return head + crc_mpeg(head).to_bytes(4, "big")


def _table_packet(pid: int, section: bytes) -> np.ndarray:
    raw = bytes([SYNC, 0x40 | pid >> 8, pid & 255, 0x10, 0]) + section
    return np.frombuffer(raw.ljust(PACKET, b"\xff"), np.uint8)


def _tables() -> np.ndarray:
    pat = _section(0, 1, bytes([0, 1, 0xE0 | PMT_PID >> 8, PMT_PID & 255]))
    es = bytes([STREAM_TYPE, 0xE0 | ES_PID >> 8, ES_PID & 255, 0xF0, 0])
    pmt = _section(2, 1, bytes([0xE0 | ES_PID >> 8, ES_PID & 255, 0xF0, 0]) + es)
    return np.stack([_table_packet(PAT_PID, pat), _table_packet(PMT_PID, pmt)])


def _template(units: int) -> tuple[np.ndarray, np.ndarray]:
    """Packets of a PES packet of so many units, and the places in them that its payload takes."""
    size = PES_HEADER + units * UNIT
    first = PACKET - 4 - 8  # beside an adaptation field with a clock reference
    later = -(-(size - first) // (PACKET - 4))
    packets = np.full((1 + later, PACKET), 0xFF, np.uint8)
    packets[:, 0], packets[:, 1], packets[:, 2], packets[:, 3] = SYNC, ES_PID >> 8, ES_PID & 255, 0x10
    packets[0, 1] |= 0x40
    packets[0, 3] = 0x30
    packets[0, 4], packets[0, 5] = 7, 0x10
    starts = np.full(1 + later, 4)
    starts[0] = 12
    left = size - first - (later - 1) * (PACKET - 4)
    if left < PACKET - 4:
        stuffing = PACKET - 4 - left
        packets[-1, 3] = 0x30
        packets[-1, 4] = stuffing - 1
        if stuffing > 1:
            packets[-1, 5] = 0
        starts[-1] = 4 + stuffing
    places = np.flatnonzero((np.arange(PACKET)[None, :] >= starts[:, None]).ravel())
    length = size - 6
    header = bytes([0, 0, 1, STREAM_ID, length >> 8, length & 255, 0x80, 0x80, 5])
    flat = packets.reshape(-1)
    flat[places[: len(header)]] = np.frombuffer(header, np.uint8)
    return packets, places


class Writer:
    """Transport streams of payloads, with one set of templates."""

    def __init__(self) -> None:
        self.tables = _tables()
        self.templates = {u: _template(u) for u in range(1, UNITS_PER_PES + 1)}

    def _pes(self, data: np.ndarray, units: int, first: int) -> np.ndarray:
        """Packets of the PES packets that hold ``data``, (number, packets, 188); ``first`` is the number of the first."""
        packets, places = self.templates[units]
        n = len(data)
        out = np.empty((n, packets.size), np.uint8)
        out[:] = packets.reshape(1, -1)
        out[:, places[PES_HEADER:]] = data
        number = np.arange(first, first + n, dtype=np.int64)
        pts = number * (UNITS_PER_PES * TICKS) & (1 << 33) - 1
        stamp = np.stack([0x21 | (pts >> 29 & 0x0E), pts >> 22 & 255, pts >> 14 & 0xFE | 1, pts >> 7 & 255, pts << 1 & 0xFE | 1], 1)
        out[:, places[9:14]] = stamp
        clock = np.stack([pts >> 25, pts >> 17 & 255, pts >> 9 & 255, pts >> 1 & 255, (pts & 1) << 7 | 0x7E, pts & 0], 1)
        out[:, 6:12] = clock
        out[:, 5] |= np.where(number % PES_PER_ACCESS == 0, 0x40, 0).astype(np.uint8)
        return out.reshape(n, -1, PACKET)

    def __call__(self, payload: bytes | None) -> bytes:
        data = np.frombuffer(payload or b"", np.uint8)
        if data.size % UNIT:
            raise ValueError(f"a payload of {data.size} bytes isn't a whole number of units of {UNIT}")
        whole, rest = divmod(data.size // UNIT, UNITS_PER_PES)
        step = UNITS_PER_PES * UNIT
        groups = []
        if whole:
            groups.append(self._pes(data[: whole * step].reshape(whole, step), UNITS_PER_PES, 0))
        if rest:
            groups.append(self._pes(data[whole * step :].reshape(1, -1), rest, whole))
        packets = np.concatenate([g.reshape(-1, PACKET) for g in groups]) if groups else np.empty((0, PACKET), np.uint8)
        packets[:, 3] |= (np.arange(len(packets)) & 15).astype(np.uint8)
        heads = np.flatnonzero((packets[:, 1] & 0x40 != 0) & (packets[:, 5] & 0x40 != 0)) if len(packets) else np.zeros(0, np.int64)
        cuts = heads if len(heads) else np.zeros(1, np.int64)
        tables = np.repeat(self.tables[None], len(cuts), 0)
        tables[:, :, 3] |= (np.arange(len(cuts)) & 15).astype(np.uint8)[:, None]
        out = np.empty((len(packets) + 2 * len(cuts), PACKET), np.uint8)
        at = cuts + 2 * np.arange(len(cuts))
        mask = np.ones(len(out), bool)
        mask[at] = mask[at + 1] = False
        out[at], out[at + 1] = tables[:, 0], tables[:, 1]
        out[mask] = packets
        return out.tobytes()


def _sections(packets: np.ndarray, starts: np.ndarray, table_id: int) -> tuple[list[bytes], int]:
    """The distinct sections of a table in one PID's packets, in order, and how many are broken.

    A section may span packets and several may share one; a packet in which one begins says where.
    """
    found, bad, held = {}, 0, b""

    def cut(data: bytes) -> bytes:
        """What is left behind the whole sections that ``data`` begins with."""
        nonlocal bad
        while len(data) >= 3 and data[0] != 0xFF:
            size = 3 + ((data[1] & 15) << 8 | data[2])
            if size > len(data):
                return data
            if size < 12 or crc_mpeg(data[:size]):
                bad += 1
            elif data[0] == table_id:
                found[data[:size]] = None
            data = data[size:]
        return b"" if data[:1] in (b"", b"\xff") else data

    known: set[bytes] = set()
    for packet, start in zip(packets, starts.tolist(), strict=True):
        raw = packet[start:].tobytes()
        if not packet[1] & 0x40:
            held = cut(held + raw) if held else b""
            continue
        if not held and raw in known:
            continue  # the same table again, whole in one packet
        before, after = raw[1 : 1 + raw[0]], raw[1 + raw[0] :]
        bad += bool(held and cut(held + before))
        held = cut(after)
        if not held:
            known.add(raw)
    return list(found), bad + bool(held)


def _fresh(packets: np.ndarray) -> np.ndarray:
    """Which packets of one PID aren't the repetition of the one before: the same count and bytes, but for the clock reference."""
    out = np.ones(len(packets), bool)
    if len(packets) > 1:
        at = np.flatnonzero((packets[1:, 3] == packets[:-1, 3]) & (packets[1:, 1] == packets[:-1, 1])) + 1
        if len(at):
            same = packets[at] == packets[at - 1]
            clocked = (packets[at, 3] & 0x20 != 0) & (packets[at, 4] > 6) & (packets[at, 5] & 0x10 != 0)
            same[clocked, 6:12] = True
            out[at[same.all(1)]] = False
    return out


def _elementary(packets: np.ndarray, starts: np.ndarray, flags: np.ndarray) -> dict:
    """Payload, stamps, and payload offsets of the random-access points of one elementary stream, or what is wrong with it."""
    out: dict = {"payload": None, "pts": [], "random_access": [], "error": None}
    if (packets[:, 3] & 0xC0).any():
        return out | {"error": "scrambled"}
    rows = np.flatnonzero(starts < PACKET)
    own, begin = packets[rows], starts[rows]
    data = own[np.arange(PACKET)[None, :] >= begin[:, None]]
    ends = np.cumsum(PACKET - begin)
    first = own[:, 1] & 0x40 != 0
    heads = (ends - (PACKET - begin))[first]
    if not len(heads) or heads[0] != 0:
        return out | {"error": "no PES packet begins"}
    h = data[np.minimum(heads[:, None] + np.arange(PES_HEADER)[None, :], len(data) - 1)].astype(np.int64)
    if (h[:, 0] | h[:, 1] | (h[:, 2] ^ 1)).any():
        return out | {"error": "no PES start code"}
    lengths = np.diff(np.append(heads, len(data)))
    said = h[:, 4] << 8 | h[:, 5]
    # a length of 0 is unbounded: such a packet ends where the next one begins
    if ((said > 0) & (said + 6 != lengths)).any():
        return out | {"error": "a PES packet has another length than it says"}
    stamped = h[:, 7] & 0x80 != 0
    pts = (h[:, 9] >> 1 & 7) << 30 | h[:, 10] << 22 | (h[:, 11] >> 1) << 15 | h[:, 12] << 7 | h[:, 13] >> 1
    # packets of these streams have neither stamps nor an optional header, and padding has no payload
    plain = np.isin(h[:, 3], PLAIN_STREAMS)
    stamped &= ~plain
    header = np.where(h[:, 3] == PADDING, lengths, np.where(plain, 6, 9 + h[:, 8]))
    if (header > lengths).any():
        return out | {"error": "a PES header is longer than its packet"}
    keep = np.ones(len(data), bool)
    for i in range(int(header[h[:, 3] != PADDING].max(initial=0))):
        keep[heads[header > i] + i] = False
    for at, n in zip(heads[h[:, 3] == PADDING].tolist(), lengths[h[:, 3] == PADDING].tolist(), strict=True):
        keep[at : at + n] = False
    access = flags[rows][first] & 0x40 != 0
    offsets = np.cumsum(lengths - header) - (lengths - header)
    return out | {"payload": data[keep].tobytes(), "pts": [int(t) if s else None for t, s in zip(pts, stamped, strict=True)], "random_access": offsets[access].tolist()}


def parse_stream(media: bytes | None) -> dict:
    """The programme tables and every elementary stream of one transport stream.

    ``payload``, ``pts`` and ``random_access`` are those of the first elementary stream, ``streams`` has them all:
    structs of pid, type, payload, pts, random_access and error. A packet that repeats the one before it is taken once. Packets
    whose transport-error bit is set count as lost and as ``transport_errors``; a scrambled stream has an error and no payload, a scrambled
    table counts as a table error.
    """
    out = {"transport_errors": 0, "payload": None, "programs": [], "continuity_errors": 0, "table_errors": 0, "pts": [], "random_access": [], "packets": 0, "duplicates": 0, "streams": [], "error": None}
    raw = np.frombuffer(media or b"", np.uint8)
    if not raw.size or raw.size % PACKET or (raw[::PACKET] != SYNC).any():
        return out | {"error": "not a transport stream"}
    packets = raw.reshape(-1, PACKET)
    out["packets"] = len(packets)
    sound = packets[:, 1] & 0x80 == 0
    out["transport_errors"] = int((~sound).sum())
    pids = np.where(sound, (packets[:, 1].astype(np.int32) & 0x1F) << 8 | packets[:, 2], -1)

    def of(pid: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """A PID's packets that carry data, without repetitions, where their data begin, and their adaptation flags; faults are counted once."""
        if pid not in read:
            rows = np.flatnonzero((pids == pid) & (packets[:, 3] & 0x10 != 0))
            own = packets[rows]
            fresh = _fresh(own)
            out["duplicates"] += int((~fresh).sum())
            own = own[fresh]
            adapted = own[:, 3] & 0x20 != 0
            starts = np.where(adapted, 5 + own[:, 4].astype(np.int32), 4)
            flags = np.where(adapted & (own[:, 4] > 0), own[:, 5], 0)
            count = own[:, 3] & 15
            jump = (count[1:] - count[:-1]) & 15
            out["continuity_errors"] += int(((jump != 1) & (flags[1:] & 0x80 == 0)).sum())
            read[pid] = own, starts, flags
        return read[pid]

    def tables(pid: int, table_id: int) -> list[bytes]:
        own, starts, _ = of(pid)
        clear = own[:, 3] & 0xC0 == 0
        out["table_errors"] += int((~clear).sum())
        inside = (starts < PACKET) & clear
        found, bad = _sections(own[inside], starts[inside], table_id)
        out["table_errors"] += bad
        return found

    read: dict[int, tuple] = {}
    streams: dict[int, int] = {}
    maps: dict[int, list[bytes]] = {}
    for pat in tables(PAT_PID, 0):
        for at in range(8, len(pat) - 4, 4):
            number, pmt_pid = pat[at] << 8 | pat[at + 1], (pat[at + 2] & 31) << 8 | pat[at + 3]
            if not number:
                continue
            if pmt_pid not in maps:
                maps[pmt_pid] = tables(pmt_pid, 2)
            for pmt in maps[pmt_pid]:
                if pmt[3] << 8 | pmt[4] != number:
                    continue  # another programme's map on the same PID
                at_es = 12 + ((pmt[10] & 15) << 8 | pmt[11])
                while at_es + 5 <= len(pmt) - 4:
                    pid = (pmt[at_es + 1] & 31) << 8 | pmt[at_es + 2]
                    streams.setdefault(pid, pmt[at_es])
                    out["programs"].append(f"{number}:{pmt_pid}:{pid}:{pmt[at_es]}")
                    at_es += 5 + ((pmt[at_es + 3] & 15) << 8 | pmt[at_es + 4])
    if not streams:
        return out | {"error": "no elementary stream"}
    out["programs"] = list(dict.fromkeys(out["programs"]))
    for pid, kind in streams.items():
        out["streams"].append({"pid": pid, "type": kind, **_elementary(*of(pid))})
    return out | {n: out["streams"][0][n] for n in ("payload", "pts", "random_access", "error")}


def store_streams(df: DataFrame, payload: str, keep: list[str], out: str = "media") -> DataFrame:
    """Add the transport stream of a binary column; the result has the columns in ``keep`` and ``out``."""

    def start():
        write = Writer()
        return lambda values: [[write(v) for v in values]]

    return map_column(df, payload, keep, [(out, T.BinaryType())], start, rows=128)


READ_FIELDS = [
    ("payload", T.BinaryType()),
    ("programs", T.ArrayType(T.StringType())),
    ("packets", T.LongType()),
    ("continuity_errors", T.LongType()),
    ("table_errors", T.LongType()),
    ("pts", T.ArrayType(T.LongType())),
    ("random_access", T.ArrayType(T.LongType())),
    ("duplicates", T.LongType()),
    ("transport_errors", T.LongType()),
    ("error", T.StringType()),
]
#: Ids of streams whose packets have no optional header, and of padding, one of them.
PLAIN_STREAMS, PADDING = (0xBC, 0xBE, 0xBF, 0xF0, 0xF1, 0xF2, 0xF8, 0xFF), 0xBE
_STREAM = "array<struct<pid: int, type: int, payload: binary, pts: array<bigint>, random_access: array<bigint>, error: string>>"


def read_streams(df: DataFrame, media: str, keep: list[str], every: bool = False) -> DataFrame:
    """Parse a column of transport streams.

    Adds ``payload``, ``programs`` (programme:table PID:stream PID:type), ``packets``,
    ``continuity_errors``, ``table_errors``, ``pts`` (one for each PES packet), ``random_access``
    (payload offsets that can be sought to), ``duplicates`` (packets that repeat the one before) and ``error`` (null if
    the stream is whole), of the first elementary stream; with ``every``, also ``streams``, all of them.
    """
    fields = [*READ_FIELDS, ("streams", T._parse_datatype_string(_STREAM))] if every else READ_FIELDS

    def start():
        def read(values):
            rows = [parse_stream(v) for v in values]
            return [[r[n] for r in rows] for n, _ in fields]

        return read

    return map_column(df, media, keep, fields, start, rows=128)


def stream_digests(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Store every whole text as a transport stream, read the stored bytes back and digest both.

    One row a document: key, ``n_bytes``, ``payload_bytes``, ``payload_sha256``, ``tail_crc32``,
    ``media_bytes``, ``media_sha256``, ``feature`` (tables, packets, PES packets, last time stamp,
    random-access points, continuity errors), ``pts`` (the time stamps) and ``random_access`` (the payload offsets of
    the random-access points). Null texts count as empty; equal texts give equal rows.
    """
    sized = docs.select(
        F.col(key),
        F.octet_length(F.coalesce(F.col(text), F.lit(""))).cast("long").alias("n_bytes"),
        unit_payload(F.col(text)).alias("payload"),
    )
    stored = store_streams(sized, "payload", [key, "n_bytes"])
    read = read_streams(
        stored.select(key, "n_bytes", "media", F.octet_length("media").cast("long").alias("media_bytes"), F.sha2("media", 256).alias("media_sha256")),
        "media",
        [key, "n_bytes", "media_bytes", "media_sha256"],
    )
    feature = F.concat_ws(
        ";",
        F.concat(F.lit("programs="), F.array_join("programs", "|")),
        F.concat(F.lit("packets="), F.col("packets").cast("string")),
        F.concat(F.lit("pes="), F.size("pts").cast("string")),
        F.concat(F.lit("last_pts="), F.coalesce(F.array_max("pts"), F.lit(-1)).cast("string")),
        F.concat(F.lit("random_access="), F.size("random_access").cast("string")),
        F.concat(F.lit("continuity_errors="), F.col("continuity_errors").cast("string")),
        F.concat(F.lit("table_errors="), F.col("table_errors").cast("string")),
    )
    return read.select(
        key,
        "n_bytes",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_sha256"),
        F.crc32(F.substring("payload", -32, 32)).alias("tail_crc32"),
        "media_bytes",
        "media_sha256",
        feature.alias("feature"),
        "pts",
        "random_access",
    )
