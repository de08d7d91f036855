from __future__ import annotations

from dataclasses import fields

import pytest

from tidemark import Contract, ContractError, load_contract
from tidemark.contract import contract_from_settings, safe_identifier


def test_defaults():
    contract = Contract()
    assert contract.strict_sheets
    assert len(contract.expected_sheets) == 5
    assert contract.id_column == "line_id"
    assert contract.sheet_keys[1] == "0_TO_7_DAYS"


def test_names_may_be_written_in_any_spelling():
    contract = Contract(id_column="Nº da Linha", required_columns=["nº da linha", "Etapa"])
    assert contract.required_columns == ("no_da_linha", "etapa")
    assert contract.id_column == "no_da_linha"


@pytest.mark.parametrize(
    "changes",
    [
        {"file_patterns": ()},
        {"expected_sheets": ()},
        {"expected_sheets": ("Overdue", " overdue ")},
        {"required_columns": ("REQUEST_ID",)},
        {"database_mode": "upsert"},
        {"database_batch_rows": 0},
        {"date_formats": ()},
        {"file_patterns": "*.xlsx"},
        {"date_formats": ("a", 3)},
        {"strict_sheets": "yes"},
        {"date_format_by_worksheet": 1},
    ],
)
def test_inconsistent_contracts_are_rejected(changes):
    with pytest.raises(ContractError, match=next(iter({"required_columns": "id_column"}.get(k, k) for k in changes))):
        Contract(**changes)


def test_all_faults_are_reported_at_once():
    with pytest.raises(ContractError, match="file_patterns.*database_mode"):
        Contract(file_patterns=(), database_mode="upsert")


GIVEN = {
    "file_patterns": ["*.xlsx"], "expected_sheets": ["Open"], "required_columns": ["key"], "id_column": "key",
    "request_column": "ask", "follow_up_notes_column": "remarks", "number_columns": ["days"], "date_columns": ["born"],
    "date_formats": ["dd.MM.yyyy"], "strict_sheets": False, "allow_empty_sheets": True, "hash_exclude": ["days"],
    "date_format_by_worksheet": True,
}
DATABASE = {"schema": "mart", "table": "states", "if_exists": "fail", "chunksize": 9}


def test_every_field_can_be_set_from_the_file():
    contract = contract_from_settings({"pipeline": GIVEN, "postgres": DATABASE, "output": {"excel_filename": "x"}})
    for name, value in GIVEN.items():
        assert getattr(contract, name) == (tuple(value) if isinstance(value, list) else value)
    assert (contract.database_schema, contract.database_table) == ("mart", "states")
    assert (contract.database_mode, contract.database_batch_rows) == ("fail", 9)
    assert set(GIVEN) | {f"database_{n}" for n in ("schema", "table", "mode", "batch_rows")} == {f.name for f in fields(Contract)}


@pytest.mark.parametrize(
    "settings", [{"pipeline": {"number_colums": ["X"]}}, {"postgres": {"url": "x"}}, {"pipelines": {}}, {"output": {"csv": 1}}]
)
def test_unknown_settings_are_named(settings):
    (section, entries), = settings.items()
    with pytest.raises(ContractError, match=next(iter(entries), section)):
        contract_from_settings(settings)


def test_settings_file(tmp_path):
    path = tmp_path / "settings.toml"
    path.write_text(
        '[pipeline]\nstrict_sheets = false\nexpected_sheets = ["Open"]\n'
        'id_column = "Key"\nrequired_columns = ["Key"]\n'
        '[postgres]\nschema = "mart"\nif_exists = "append"\nchunksize = 10\n',
        encoding="utf-8",
    )
    contract = load_contract(path)
    assert (contract.strict_sheets, contract.expected_sheets) == (False, ("Open",))
    assert (contract.database_schema, contract.database_mode) == ("mart", "append")
    assert contract.database_batch_rows == 10
    assert load_contract() == Contract()
    with pytest.raises(ContractError, match="not found"):
        load_contract(tmp_path / "none.toml")
    path.write_text("pipeline = 3\n", encoding="utf-8")
    with pytest.raises(ContractError, match="table"):
        load_contract(path)


def test_database_identifiers():
    assert safe_identifier("analytics_1") == "analytics_1"
    for name in ("a-b", "1a", 'x"; DROP TABLE y', ""):
        with pytest.raises(ContractError):
            safe_identifier(name)
