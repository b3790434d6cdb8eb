"""States, labels and days that are derived from several fields of a record, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import text

#: Words of a situation that say a vote is near, endings of a procedure, and words of a step that changes the state. On folded text.
NEAR_VOTE = ["sancao", "pauta", "ordem do dia", "pront", "redacao final", "votacao marcad", "incluida na ordem", "aguardando votacao"]
ENDED = ["arquivad", "prejudicad", "transformada em norma", "convertida em norma", "promulgad"]
BECAME_LAW = ["sancion", "transformada em norma", "convertida"]
DECISIVE = ["parecer", "votac", "aprovad", "rejeitad", "pauta", "ordem do dia", "redacao final"]

#: Titles that only repeat a protocol or announce a purchase, and marks the collector puts into titles. Read without case.
COLLECTOR_MARKS = r"(?i)\(\s*registro incorporado\s*\)|\(\s*alinhamento de texto à ficha oficial\s*\)"
PROTOCOL = r"^(pl|plc|pec|pdl|pln|mpv|mp|req)\s*\d+\s*/\s*\d+\s*:\s*(apresentacao de proposicao|publicacao de proposicao|recebimento)\b"
NOISE = ["extrato", "resultado de (julgamento|chamamento|licita)", "edital de (concurso|licita)", "aviso de (licita|altera)", "pregao", "ata de (julgamento|sessao)", "credenciamento", "carta comercial", "comunicado", "retificacao", "homologacao", "concorrencia", "termo aditivo", "ordem de compra", "convite"]


def has_any(folded: Column, words: list[str]) -> Column:
    """Whether folded text contains any of the words; null text contains none."""
    found = F.lit(False)
    for w in words:
        found = found | F.coalesce(folded.contains(w), F.lit(False))
    return found


def near_vote(situation: Column) -> Column:
    return has_any(text.fold(situation), NEAR_VOTE)


def situation(stored: Column, step: Column, order: Column, body: Column, day: Column) -> Column:
    """The situation after a step: ended procedures stay ended unless they are taken up again, steps of mere routine change nothing.

    stored is the situation so far, step and order the step's description and ruling, body where it was taken, day its day. Nulls count as empty text.
    """
    s, t = text.fold(stored), text.fold(F.concat_ws(" ", F.coalesce(step, F.lit("")), F.coalesce(order, F.lit(""))))
    old, step, order, body = (F.coalesce(c, F.lit("")) for c in (stored, step, order, body))
    told = F.trim(F.concat(F.trim(step), F.lit(" ("), F.trim(body), F.lit("): "), F.substring(F.trim(order), 1, 220)))
    kind, number, year = (F.regexp_extract(order, r"(?i)apense-se\s+[aà](?:\(ao\))?\s*([A-Za-z]{2,4})\s*(\d{1,5})/(\d{4})", k) for k in (1, 2, 3))
    target = F.concat(F.upper(kind), F.lit(" "), number, F.lit("/"), year)
    leaves = t.contains("desapens")
    return (
        F.when(t.contains("desarquiv"), F.concat(F.lit("Desarquivada — "), told)).when(has_any(s, ENDED), old).when(t.contains("apens") & ~leaves, old)
        .when(leaves & (kind != "") & s.contains(F.lower(target)), old).when(leaves & (kind != ""), F.concat(F.lit("Apensado ao "), target, F.lit(" (despacho de "), F.coalesce(day, F.lit("correção")), F.lit(")")))
        .when(leaves, F.concat(F.lit("Desapensada — "), told)).when(s.contains("sancao") & t.contains("sancao"), old)
        .when(has_any(t, BECAME_LAW), F.trim(F.concat(F.lit("Convertida em norma — "), F.trim(step), F.lit(": "), F.substring(F.trim(order), 1, 220))))
        .when(t.contains("sancao"), F.lit("Aguarda sanção presidencial")).when(has_any(t, DECISIVE), told).otherwise(old)
    )


def house_status(checked: Column, failed: Column) -> Column:
    """'falha' where nothing was checked, 'parcial' where some checks failed, else 'ok'. Nulls count as none."""
    return F.when(F.coalesce(checked, F.lit(0)) <= 0, "falha").when(F.coalesce(failed, F.lit(0)) > 0, "parcial").otherwise("ok")


def source_status(done: Column, failed_required: Column, out_of_time: Column) -> Column:
    """Status of a source from how many of its channels answered and how many required ones did not; optional ones don't count."""
    return F.when(F.coalesce(done, F.lit(0)) == 0, "falha").when((F.coalesce(failed_required, F.lit(0)) > 0) | F.coalesce(out_of_time, F.lit(False)), "parcial").otherwise("ok")


def run_status(status: Column, hours: Column) -> Column:
    """Status shown of a run: one in progress for more than three hours was interrupted; unknown ones count as done."""
    going = F.when(hours > 3, "interrompida").otherwise("em_andamento")
    return F.when(status == "em_andamento", going).when(status.isin("concluida", "parcial", "falhou", "interrompida"), status).otherwise("concluida")


def age_text(hours: Column) -> Column:
    """Age as hours below two days and as days from there on, with one decimal; '—' for null."""
    return F.when(hours.isNull(), "—").when(hours < 48, F.format_string("%.1f h", hours.cast("double"))).otherwise(F.format_string("%.1f dias", (hours / 24).cast("double")))


def first_day(candidates: list[Column], least: str, otherwise: Column) -> Column:
    """The first candidate that begins with an ISO day not before ``least``."""
    days = [F.nullif(F.regexp_extract(c.cast("string"), r"^\s*(\d{4}-\d{2}-\d{2})", 1), F.lit("")) for c in candidates]
    return F.coalesce(*[F.when(d >= least, d) for d in days], otherwise)


def run_day(value: Column) -> Column:
    """The day of a run written as a time with offset, a time without one, or a day; null for anything else."""
    v = F.trim(value.cast("string"))
    shaped = v.rlike(r"^\d{4}-\d{2}-\d{2}(T\d{2}:\d{2}:\d{2}([+-]\d{2}:?\d{2}|Z)?)?$")
    return F.when(shaped, F.date_format(F.try_to_date(F.substring(v, 1, 10), "yyyy-MM-dd"), "yyyy-MM-dd"))


def guessed_principal(named: Column, status: Column) -> Column:
    """The principal proposition: the one named, else the one the situation says it is attached to."""
    part = [F.regexp_extract(status, r"Apensad[oa] ao ([A-Z]{2,4})\s*(\d{1,5})/(\d{4})", k) for k in (1, 2, 3)]
    return F.coalesce(F.nullif(named, F.lit("")), F.when(part[0] != "", F.concat_ws("_", F.lit("camara"), F.lower(part[0]), part[1], part[2])))


def clean_title(title: Column) -> Column:
    """A title without the collector's marks and with single blanks."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.coalesce(title, F.lit("")), COLLECTOR_MARKS, " "), r"\s+", " "))


def protocol_echo(title: Column) -> Column:
    return text.fold(clean_title(title)).rlike(PROTOCOL)


def noisy(title: Column) -> Column:
    return text.fold(F.trim(F.coalesce(title, F.lit("")))).rlike("^(" + "|".join(NOISE) + ")")


def outbox_next(status: Column, attempts: Column, due: Column, now: Column, wanted: Column, outcome: Column, lease: int = 300, longest: int = 86400) -> Column:
    """struct(status, attempts, due) after a delivery run at ``now`` (epoch seconds).

    Sent and cancelled messages, and those not due, stay as they are; a message nobody wants any more is cancelled. One that is tried is 'sending' under a lease while its
    outcome is null, 'sent' after 'ok', and otherwise 'retry' after a wait that doubles with each attempt. A lease that has run out is due again.
    """
    tried = F.coalesce(attempts, F.lit(0)) + 1
    wait = F.least(F.lit(longest).cast("bigint"), (60 * F.pow(F.lit(2), F.least(tried, F.lit(10)))).cast("bigint"))
    state = lambda s, a, d: F.struct(s.alias("status"), a.cast("int").alias("attempts"), d.cast("bigint").alias("due"))
    kept = status.isin("sent", "cancelled") | (F.coalesce(due, F.lit(0)) > now)
    return (
        F.when(kept, state(status, attempts, due)).when(~wanted, state(F.lit("cancelled"), attempts, due))
        .when(outcome.isNull(), state(F.lit("sending"), tried, now + lease)).when(outcome == "ok", state(F.lit("sent"), tried, now + lease)).otherwise(state(F.lit("retry"), tried, now + wait))
    )
