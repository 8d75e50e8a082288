import pytest

from objsync.config import ResourceConfig, TargetConfig, validate_resources

GOOD = {"name": "accounts", "object": "Account", "primary_key": "Id", "fields": ["Id", "Name", "LastModifiedDate"],
        "write_disposition": "append", "replication_key": "LastModifiedDate"}


def test_valid_configs_keep_order():
    contacts = {**GOOD, "name": "contacts", "object": "Contact", "primary_key": ["Id", "Email"]}
    configs = validate_resources([GOOD, contacts])
    assert [c.name for c in configs] == ["accounts", "contacts"]
    assert configs[0].keys == ("Id",) and configs[1].keys == ("Id", "Email")


def test_no_configs():
    with pytest.raises(ValueError, match="No resource"):
        validate_resources([])


@pytest.mark.parametrize("missing", ["name", "primary_key", "object"])
def test_missing_field_names_the_index(missing):
    bad = {k: v for k, v in GOOD.items() if k != missing}
    with pytest.raises(ValueError, match=f"resource 1: no {missing}"):
        validate_resources([GOOD, bad])


@pytest.mark.parametrize("change, message", [
    ({"fields": "Id"}, "fields is not a list"),
    ({"write_disposition": "update"}, "write_disposition update is not one of"),
    ({"replication_key": "CreatedDate"}, "is not among the fields"),
])
def test_bad_structure(change, message):
    with pytest.raises(ValueError, match=message):
        validate_resources([{**GOOD, **change}])


def test_cursor_without_fields_is_allowed():
    config = validate_resources([{k: v for k, v in GOOD.items() if k != "fields"}])[0]
    assert config.fields == () and config.write_disposition == "append"


def test_loader_type_hints():
    config = ResourceConfig.from_dict({**GOOD, "column_types": {"website": {"data_type": "text"}, "n": "bigint"}})
    assert config.column_types == {"website": "text", "n": "bigint"}


def hints(**changes):
    return {"name": "Account", "write_disposition": "append", "operation": "insert", **changes}


@pytest.mark.parametrize("operation", ["insert", "upsert", "delete"])
def test_append_takes_its_operation(operation):
    assert TargetConfig.from_hints(hints(operation=operation)).operation == operation


def test_replace_overrides_the_hint():
    config = TargetConfig.from_hints(hints(write_disposition="replace", operation="insert"))
    assert config.operation == "replace" and config.primary_key is None


def test_merge_is_a_keyed_upsert():
    assert TargetConfig.from_hints(hints(write_disposition="merge", operation=None)).operation == "merge"


@pytest.mark.parametrize("changes, message", [
    ({"name": None}, "has no name"),
    ({"operation": None}, "append needs an operation"),
    ({"operation": "update"}, "append needs an operation"),
    ({"operation": "UPSERT"}, "append needs an operation"),
    ({"write_disposition": "skip"}, "unknown write_disposition"),
    ({"write_disposition": None}, "unknown write_disposition"),
])
def test_refused_hints(changes, message):
    with pytest.raises(ValueError, match=message):
        TargetConfig.from_hints(hints(**changes))


@pytest.mark.parametrize("given, resolved", [
    ({"primary_key": "Email"}, "Email"),
    ({"primary_key": ["Email"]}, ("Email",)),
    ({"columns": {"Id": {"primary_key": True}, "Name": {}}}, "Id"),
    ({"columns": {"A": {"primary_key": True}, "B": {"primary_key": True}}}, ("A", "B")),
    ({"primary_key": "Email", "columns": {"Id": {"primary_key": True}}}, "Email"),
    ({"columns": {"Name": {"primary_key": False}}}, None),
    ({}, None),
])
def test_primary_key_resolution(given, resolved):
    assert TargetConfig.from_hints(hints(**given)).primary_key == resolved


def test_matching_keys_are_the_first_or_all_and_never_dotted():
    assert TargetConfig("Account", "upsert", primary_key=("ExternalId", "Email")).matching_keys == ("ExternalId",)
    assert TargetConfig("Account", "merge", primary_key=("ExternalId", "Email")).matching_keys == ("ExternalId", "Email")
    with pytest.raises(ValueError, match="Not a name"):
        TargetConfig("Account", "upsert", primary_key="Owner.Email").matching_keys
    with pytest.raises(ValueError, match="needs a key"):
        TargetConfig("Account", "merge").matching_keys


@pytest.mark.parametrize("key, expected", [("Id", True), ("id", True), (("ID", "x"), True), ("Email", False), (None, False)])
def test_keyed_by_id(key, expected):
    assert TargetConfig("Account", "delete", primary_key=key).keyed_by_id is expected
