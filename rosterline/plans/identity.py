"""Users and roles: desired-state sync, grants, migration between databases, alignment with a master.

The account tables may live in another database than the campus tables; ``db``
arguments are registry aliases.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import replace
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates
from ..functions.text import text_key
from ..models import campus as m
from ..operators import changes, joins, sets
from ..operators.changes import ChangeSet
from ..sources.registry import TableRegistry
from ..staging import stage

# Modes of the account stores (directory, federation).
DIRECTORY_MODE, FEDERATED_MODE = 2, 3


def _application_id(t: TableRegistry, application: str, db: str) -> Column:
    return t.table("Application", db).filter(F.col("Name") == application).agg(F.max("ApplicationId").alias("id")).scalar()


def _store_id(t: TableRegistry, application_id: Column, mode: int, db: str) -> Column:
    stores = t.table("AppStore", db).filter((F.col("ApplicationId") == application_id) & (F.col("Mode") == mode))
    return stores.agg(F.max("AppStoreId").alias("id")).scalar()


def role_map(t: TableRegistry, application: str, db: str) -> DataFrame:
    """Application roles and the record types mapped to them."""
    roles = t.table("AppRole", db).filter(F.col("ApplicationId") == _application_id(t, application, db))
    return (
        t["SiteMapRole"].select("RoleName")
        .join(t["PersonTypeRole"], "RoleName")
        .join(t["CODE_RECORDTYPE"].select(F.col("RecordTypeId").alias("PersonTypeId"), F.col("CODE_VALUE_KEY").alias("RECORDTYPE")), "PersonTypeId")
        .join(roles.select("AppRoleId", F.col("Name").alias("RoleName")), "RoleName")
        .select("AppRoleId", "RECORDTYPE")
    )


def desired_roles(t: TableRegistry, application: str, operator_roles: Mapping[str, Sequence[str] | None], db: str) -> DataFrame:
    """Distinct (UserName, AppUserId, AppRoleId) that should hold.

    Record types give their mapped roles; each entry of ``operator_roles`` gives a
    role to active operators with one of the listed profiles (None = any profile);
    accounts with a local password keep what they have. AppUserId is null for
    users without an account.
    """
    users = t["PersonUser"].select("PersonId", "UserName").join(t["PEOPLE"].select("PersonId", "PEOPLE_ID", "PEOPLE_CODE_ID"), "PersonId")
    active_types = t["CODE_RECORDTYPE"].filter(F.col("STATUS") == "A")
    types = joins.semi(t["PEOPLETYPE"], active_types, {"PEOPLE_TYPE": "CODE_VALUE_KEY"}).select("PEOPLE_ID", F.col("PEOPLE_TYPE").alias("RECORDTYPE")).distinct()
    branches = [users.join(types, "PEOPLE_ID").join(role_map(t, application, db), "RECORDTYPE").select("UserName", "AppRoleId")]

    operators = t["ABT_USERS"].filter(F.col("STATUS") == "A").select("OPERATOR_ID", "PEOPLE_CODE_ID")
    held = t["ABT_USERPROFILE"].join(operators, "OPERATOR_ID").select("PEOPLE_CODE_ID", "PROFILE_CODE")
    app = _application_id(t, application, db)
    for role, profiles in operator_roles.items():
        people = held if profiles is None else held.filter(F.col("PROFILE_CODE").isin(*profiles))
        role_id = t.table("AppRole", db).filter((F.col("Name") == role) & (F.col("ApplicationId") == app)).agg(F.max("AppRoleId").alias("r")).scalar()
        branches.append(joins.semi(users, people, ["PEOPLE_CODE_ID"]).select("UserName", role_id.alias("AppRoleId")))

    named = sets.union_branches(branches, distinct=True)
    accounts = t.table("AppUser", db).select("UserName", "AppUserId", "Password")
    from_people = named.join(accounts.drop("Password"), "UserName", "left").select("UserName", "AppUserId", "AppRoleId")
    local = joins.semi(t.table("AppUserRole", db), accounts.filter(F.col("Password") != ""), ["AppUserId"]).select(
        F.lit(None).cast("string").alias("UserName"), "AppUserId", "AppRoleId"
    )
    return sets.union_branches([from_people, local], distinct=True)


def sync_identity(t: TableRegistry, application: str, operator_roles: Mapping[str, Sequence[str] | None], db: str) -> dict[str, ChangeSet | DataFrame]:
    """Bring accounts and their roles to the desired state; roles without a record type are taken away
    only with their account. Ids of deleted accounts are not given out again."""
    app = _application_id(t, application, db)
    accounts = t.table("AppUser", db)
    # Read for the new accounts and again for the roles: computed once.
    desired = stage(desired_roles(t, application, operator_roles, db))

    orphans = joins.anti(
        accounts.filter((F.col("Password") == "") & (F.col("ApplicationId") == app)), t["PersonUser"], ["UserName"]
    )
    removed = changes.delete_matching(accounts, orphans, ["AppUserId"])

    emails = t["EmailAddress"].select(F.col("EmailAddressId").alias("PrimaryEmailId"), "Email")
    addresses = t["PersonUser"].join(t["PEOPLE"].select("PersonId", "PrimaryEmailId"), "PersonId", "left").join(emails, "PrimaryEmailId", "left")
    new = desired.filter(F.col("AppUserId").isNull()).select("UserName").distinct().join(
        addresses.select("UserName", "Email").distinct(), "UserName", "left"
    )
    rows = new.select(
        app.alias("ApplicationId"), "UserName", F.lower("UserName").alias("LoweredUserName"), "Email", F.lit("").alias("LoweredEmail"),
        F.lit("").alias("Password"), F.lit(0).alias("ChangePasswordAtNextLogon"),
        _store_id(t, app, DIRECTORY_MODE, db).alias("CreationAppStoreId"), _store_id(t, app, FEDERATED_MODE, db).alias("AuthenticationAppStoreId"),
    )
    numbered_changes, numbered = changes.insert_returning(removed.new_state, rows, "AppUserId", ["UserName", "Email"], used=accounts)
    users = ChangeSet(numbered_changes.new_state, removed.changes.unionByName(numbered_changes.changes))

    ids = numbered.select("UserName", F.col("AppUserId").alias("_new_id"))
    complete = desired.join(ids, "UserName", "left").select(F.coalesce("AppUserId", "_new_id").alias("AppUserId"), "AppRoleId").distinct()
    ended = changes.delete_matching(t.table("AppUserRole", db), orphans, ["AppUserId"])
    synced = changes.sync_to(
        ended.new_state, complete, ["AppUserId", "AppRoleId"], role_map(t, application, db).select("AppRoleId"), ["AppRoleId"]
    )
    roles = ChangeSet(synced.new_state, ended.changes.select(*synced.changes.columns).unionByName(synced.changes))
    names = accounts.select("AppUserId", "UserName").unionByName(numbered.select("AppUserId", "UserName"))
    report = joins.lookup(roles.changes, names, {"AppUserId": "AppUserId"}, {"UserName": "UserName"})
    report = joins.lookup(report, t.table("AppRole", db), {"AppRoleId": "AppRoleId"}, {"RoleName": "Name"})
    people = t["PersonUser"].join(t["PEOPLE"].select("PersonId", "PEOPLE_ID"), "PersonId").select("UserName", "PEOPLE_ID")
    report = report.join(people, "UserName", "left")
    return {"AppUser": users, "AppUserRole": roles, "report": report}


def grant_all(t: TableRegistry, role: str, db: str, application_id: int | None = None) -> dict[str, ChangeSet]:
    """Give one role every claim (of one application when given) and every site-map entry; an unknown role gets nothing."""
    of_app = F.lit(True) if application_id is None else F.col("ApplicationId") == application_id
    role_id = t.table("AppRole", db).filter((F.col("Name") == role) & of_app).agg(F.max("AppRoleId").alias("r")).scalar()
    claims = t.table("AppClaim", db).filter(of_app).select(role_id.alias("AppRoleId"), "AppClaimId").filter("AppRoleId IS NOT NULL")
    site_role = t["SiteMapRole"].filter(F.col("RoleName") == role).agg(F.max("SiteMapRoleId").alias("r")).scalar()

    def entries(table: str, key: str) -> DataFrame:
        return t[table].select(key, site_role.alias("SiteMapRoleId"), F.lit(True).alias("IsVisible")).filter("SiteMapRoleId IS NOT NULL")

    return {
        "AppRoleClaim": changes.insert_missing(t.table("AppRoleClaim", db), claims, ["AppRoleId", "AppClaimId"]),
        "SiteMapOptionRole": changes.insert_missing(
            t["SiteMapOptionRole"], entries("SiteMapOption", "SiteMapOptionId"), ["SiteMapOptionId", "SiteMapRoleId"]
        ),
        "SiteMapOptionDetailRole": changes.insert_missing(
            t["SiteMapOptionDetailRole"], entries("SiteMapOptionDetail", "SiteMapOptionDetailId"), ["SiteMapOptionDetailId", "SiteMapRoleId"]
        ),
    }


def _insert_named(old: DataFrame, new: DataFrame, natural: list[str], id_column: str) -> ChangeSet:
    missing = joins.anti(old, new, natural)
    added, _ = changes.insert_returning(new, missing, id_column, natural)
    return added


def _link(t: TableRegistry, old: str, new: str, table: str, sides: Mapping[str, tuple[DataFrame, DataFrame, str]]) -> ChangeSet:
    """Copy a link table with both ids remapped through their natural keys, skipping links that exist.

    Natural keys that occur twice go to the gate: a run with any is refused before it writes.
    """
    rows, witness = t.table(table, old), None
    for id_column, (old_dim, new_dim, natural) in sides.items():
        rows = joins.remap_keys(rows, id_column, old_dim, new_dim, id_column, [natural])
        repeated = joins.repeated_natural_keys(old_dim, new_dim, [natural])
        witness = repeated if witness is None else witness.unionByName(repeated)
    return replace(changes.insert_missing(t.table(table, new), rows, list(sides)), repeated=witness)


def migrate_settings(
    t: TableRegistry, old: str, new: str, old_identity: str, new_identity: str, application: str, as_of: datetime, areas: Sequence[str] = ("Theme",)
) -> dict[str, ChangeSet]:
    """Carry custom roles, menu entries, their links, chosen settings, and role claims to another database.

    Ids are matched through names; a link whose counterpart does not exist is left out.
    """
    custom = F.col("IsCustom")
    roles = _insert_named(t.table("SiteMapRole", old).filter(custom), t.table("SiteMapRole", new), ["RoleName"], "SiteMapRoleId")
    options = _insert_named(t.table("SiteMapOption", old).filter(custom), t.table("SiteMapOption", new), ["LinkId"], "SiteMapOptionId")
    old_details = joins.remap_keys(
        t.table("SiteMapOptionDetail", old).filter(custom), "SiteMapOptionId", t.table("SiteMapOption", old), options.new_state, "SiteMapOptionId", ["LinkId"]
    )
    details = _insert_named(old_details, t.table("SiteMapOptionDetail", new), ["LinkId"], "SiteMapOptionDetailId")
    role_side = (t.table("SiteMapRole", old), roles.new_state, "RoleName")
    out = {"SiteMapRole": roles, "SiteMapOption": options, "SiteMapOptionDetail": details}
    out["SiteMapOptionRole"] = _link(
        t, old, new, "SiteMapOptionRole",
        {"SiteMapOptionId": (t.table("SiteMapOption", old), options.new_state, "LinkId"), "SiteMapRoleId": role_side},
    )
    out["SiteMapOptionDetailRole"] = _link(
        t, old, new, "SiteMapOptionDetailRole",
        {"SiteMapOptionDetailId": (t.table("SiteMapOptionDetail", old), details.new_state, "LinkId"), "SiteMapRoleId": role_side},
    )
    now = dates.moment(as_of)
    source = t.table("InstitutionSetting", old).filter(F.col("AreaName").isin(*areas)).select("AreaName", "SectionName", "LabelName", "Setting", "PersonId")
    out["InstitutionSetting"] = changes.upsert(
        t.table("InstitutionSetting", new), source, ["AreaName", "SectionName", "LabelName"],
        {"Setting": F.col("s.Setting"), "RevisionDatetime": now, "PersonId": F.col("s.PersonId")},
        {"CreateDatetime": now, "RevisionDatetime": now},
    )
    old_app, new_app = _application_id(t, application, old_identity), _application_id(t, application, new_identity)
    old_roles = t.table("AppRole", old_identity).filter(F.col("ApplicationId") == old_app)
    wanted = old_roles.withColumn("ApplicationId", new_app)
    out["AppRole"] = _insert_named(wanted, t.table("AppRole", new_identity), ["ApplicationId", "Name"], "AppRoleId")
    out["AppRoleClaim"] = _link(
        t, old_identity, new_identity, "AppRoleClaim",
        {
            "AppRoleId": (t.table("AppRole", old_identity), out["AppRole"].new_state, "Name"),
            "AppClaimId": (t.table("AppClaim", old_identity), t.table("AppClaim", new_identity), "Name"),
        },
    )
    return out


def correct_identity(t: TableRegistry, application: str, db: str) -> ChangeSet:
    """Take the case of user names from the master, set the stores, drop users the master lacks."""
    app = _application_id(t, application, db)
    directory, federated = _store_id(t, app, DIRECTORY_MODE, db), _store_id(t, app, FEDERATED_MODE, db)
    master = t["PersonUser"].select(text_key("UserName").alias("_key"), F.col("UserName").alias("_name"))
    master = master.groupBy("_key").agg(F.min("_name").alias("_name"))
    accounts = t.table("AppUser", db).withColumn("_key", text_key("UserName"))
    ours = F.col("ApplicationId") == app

    named = changes.update_from(
        accounts, master.withColumn("_lowered", F.lower("_name")), ["_key"], {"UserName": "_name", "LoweredUserName": "_lowered"}, ours
    ).new_state
    wrong = ours & (
        (F.coalesce("AuthenticationAppStoreId", F.lit(0)) != federated) | (F.coalesce("CreationAppStoreId", F.lit(0)) != directory)
    )
    stored = changes.update_where(named, wrong, {"AuthenticationAppStoreId": federated, "CreationAppStoreId": directory}).new_state
    others = stored.filter(~ours | F.col("ApplicationId").isNull())
    known = joins.semi(stored.filter(ours), master, ["_key"])
    final = others.unionByName(known).drop("_key")

    before, after = t.table("AppUser", db), final
    deleted = joins.anti(before, after, ["AppUserId"]).withColumn("action", F.lit("DELETE"))
    old_rows = before.select("AppUserId", F.struct("UserName", "LoweredUserName", "CreationAppStoreId", "AuthenticationAppStoreId").alias("_old"))
    changed = after.join(old_rows, "AppUserId").filter(
        ~F.struct("UserName", "LoweredUserName", "CreationAppStoreId", "AuthenticationAppStoreId").eqNullSafe(F.col("_old"))
    ).drop("_old").withColumn("action", F.lit("UPDATE"))
    return ChangeSet(final, deleted.unionByName(changed))
