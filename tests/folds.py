"""Row-by-row models of the stateful operators, for comparison on small random inputs."""

from __future__ import annotations

import hashlib


def upsert_fold(stored: list[dict], batch: list[dict], as_of: str):
    """``stored`` rows: id, url_id, reference, objet, acheteur, date_limite, hash_content, status, last_seen."""
    table = [dict(r) for r in stored]
    new = updated = 0
    flags = []
    for row in sorted(batch, key=lambda r: (r["page"], r["row"])):
        uid = row["url_id"]
        if uid:
            hits = [t for t in table if t["url_id"] == uid]
        else:
            hits = [t for t in table if not t["url_id"] and t["reference"] == row["reference"]]
        if not hits:
            table.append({"id": None, "url_id": uid or None, "reference": row["reference"], "objet": row["objet"],
                          "acheteur": row["acheteur"], "date_limite": row["date_limite"], "hash_content": row["page_hash"],
                          "status": "TO_ENRICH", "last_seen": as_of})
            new += 1
            flags.append(True)
            continue
        t = min(hits, key=lambda t: (t["id"] is None, t["id"] or 0))
        flags.append(t["hash_content"] != row["page_hash"])
        if flags[-1]:
            t.update(date_limite=row["date_limite"], hash_content=row["page_hash"], status="TO_ENRICH")
            for f in ("objet", "acheteur"):
                if row[f]:
                    t[f] = row[f]
            updated += 1
        t["last_seen"] = as_of
    return table, new, updated, flags


def minutes_fold(stored: list[dict], batch: list[dict]):
    table = [dict(r) for r in stored]
    for r in sorted(batch, key=lambda r: r["seq"]):
        if not r["pdf_url"]:
            continue
        h = hashlib.md5(r["pdf_url"].encode()).hexdigest()
        known = next((t for t in table if t["hash_pdf"] == h), None)
        if known is None:
            table.append({"hash_pdf": h, **{k: r[k] for k in ("tender_id", "reference", "pdf_url", "procedure_type", "date_publication")}})
        elif r["date_publication"] and not known["date_publication"]:
            known["date_publication"] = r["date_publication"]
    return table


def orphan_fold(tenders: list[dict], batch: list[dict]):
    """``tenders``: id, url_id, reference, created (int). Returns links by seq and the founded rows' seqs."""
    by_uid = {}
    by_ref = {}
    for t in tenders:
        if t["url_id"]:
            by_uid[t["url_id"]] = min(t["id"], by_uid.get(t["url_id"], t["id"]))
        best = by_ref.get(t["reference"])
        if best is None or (t["created"], -t["id"]) > (best[0], -best[1]):
            by_ref[t["reference"]] = (t["created"], t["id"])
    by_ref = {k: v[1] for k, v in by_ref.items()}
    links, founders = {}, []
    for r in sorted(batch, key=lambda r: r["seq"]):
        found = by_uid.get(r["uid"]) if r["uid"] else None
        if found is None:
            found = by_ref.get(r["reference"])
        if found is None:
            found = ("new", r["seq"])
            founders.append(r["seq"])
            if r["uid"]:
                by_uid[r["uid"]] = found
            by_ref[r["reference"]] = found
        links[r["seq"]] = found
    return links, founders
