"""A seeded generator of listing rows for demonstrations: invented titles, companies and places, with reposts."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

COLUMNS = ("source_job_id", "title", "company_name", "location_raw", "salary_raw", "education_raw", "experience_raw", "employment_type", "description", "posted_days_ago", "valid_days_ahead")
TITLES = ("Analis Data", "Teknisi Pompa", "Juru Masak", "Penata Kebun", "Petugas Arsip", "Perancang Busana", "Pengantar Surat", "Juru Rawat", "Penulis Naskah", "Montir Sepeda")
FIRMS = ("PT Rekaan Satu", "CV Rekaan Dua", "PT Rekaan Tiga Tbk", "Kedai Rekaan", "Yayasan Rekaan")
PLACES = ("Kota Bandung", "Jakarta Selatan", "Surabaya, Jawa Timur", "Depok", "Remote")
PAY = ("{a}-{b} jt", "Rp {a}.000.000 - Rp {b}.000.000", "{a},5 juta / bulan", "Kompetitif", "")
SCHOOL, YEARS, KINDS = ("SMA/SMK", "D3", "S1", "bebas"), ("Fresh graduate", "2 tahun", "1-3 tahun", ""), ("Full Time", "Kontrak", "Magang", "Part Time")


def rows(n: int, seed: int = 1, reposts: float = 0.15) -> list[tuple]:
    """n rows; about a share of `reposts` repeats an earlier row under a new id, in slightly changed words."""
    rnd = random.Random(seed)
    out: list[tuple] = []
    for i in range(n):
        if out and rnd.random() < reposts:
            old = rnd.choice(out)
            out.append((str(i), *old[1:8], old[8] + rnd.choice(("", " Segera.", " Lamar sekarang.")), str(rnd.randint(0, 59)), old[10]))
            continue
        title, a = rnd.choice(TITLES), rnd.randint(3, 15)
        contact = rnd.choice(("", f" Kirim surat ke lamaran{rnd.randint(1, 99)}@contoh.id.", f" Hubungi Sari di 0812-{rnd.randint(1000, 9999)}-{rnd.randint(1000, 9999)}."))
        text = f"{title} bertugas {rnd.choice(('merawat', 'menyusun', 'memeriksa'))} {rnd.choice(('barang', 'laporan', 'peralatan'))} setiap hari.{contact}"
        out.append((str(i), title, rnd.choice(FIRMS), rnd.choice(PLACES), rnd.choice(PAY).format(a=a, b=a + 2), rnd.choice(SCHOOL), rnd.choice(YEARS), rnd.choice(KINDS), text, str(rnd.randint(0, 59)), str(rnd.randint(1, 40))))
    return out


def listings(spark: SparkSession, n: int = 600, seed: int = 1) -> DataFrame:
    return spark.createDataFrame(rows(n, seed), ", ".join(f"{c} string" for c in COLUMNS))
