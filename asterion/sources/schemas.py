"""Schemas of the catalogue tables, written as DDL.

Instants without zone are UTC. Arbitrary-precision numbers of the catalogue are
doubles here; a decimal is only used when text is formatted.
"""

_DES = "packed_primary_provisional_designation string, unpacked_primary_provisional_designation string"
_ROW = "created_at timestamp_ntz, updated_at timestamp_ntz"


def _doubles(names: str) -> str:
    return ", ".join(f"{n} double" for n in names.split())


def _strings(names: str) -> str:
    return ", ".join(f"{n} string" for n in names.split())


_NEOCP_OBS = f"id int, {_strings('desig trkid obs80')}, {_doubles('rmstime rmsra rmsdec rmscorr')}, force_code string, {_ROW}"

SCHEMAS = {
    "comet_names": f"id int, {_DES}, name string, naming_publication_references array<string>, {_ROW}",
    "current_identifications": (
        f"id int, {_DES}, packed_secondary_provisional_designation string, "
        "unpacked_secondary_provisional_designation string, published int, "
        f"identifier_ids array<string>, object_type int, numbered boolean, {_ROW}"),
    "minor_planet_names": (
        f"id int, {_strings('mp_number name reference citation discoverers')}, {_ROW}"),
    "mpc_orbits": (
        f"id int, {_DES}, mpc_orb_jsonb string, orbit_type_int int, u_param int, nopp int, "
        "nobs_total int, nobs_total_sel int, fitting_datetime timestamp_ntz, " + _doubles(
            "arc_length_total arc_length_sel a q e i node argperi peri_time yarkovsky srp a1 a2 a3 dt "
            "mean_anomaly period mean_motion a_unc q_unc e_unc i_unc node_unc argperi_unc "
            "peri_time_unc yarkovsky_unc srp_unc a1_unc a2_unc a3_unc dt_unc mean_anomaly_unc "
            "period_unc mean_motion_unc epoch_mjd h g not_normalized_rms normalized_rms earth_moid")
        + f", {_ROW}"),
    "neocp_els": f"id int, {_strings('desig els dsc_obs flag prep comet')}, digest2 double, {_ROW}",
    "neocp_events": f"id int, {_strings('desig event_type event_text event_user')}, {_ROW}",
    "neocp_obs": _NEOCP_OBS,
    "neocp_obs_archive": _NEOCP_OBS,
    "neocp_prev_des": f"id int, {_strings('desig status iau_desig pkd_desig ref')}, digest2 double, {_ROW}",
    "neocp_var": f"id int, {_strings('desig els')}, {_ROW}",
    "numbered_identifications": (
        f"id int, {_DES}, {_strings('permid iau_designation iau_name naming_credit')}, "
        f"numbered_publication_references array<string>, named_publication_references array<string>, {_ROW}"),
    "obs_alterations_corrections": f"id int, obsid_old string, obsid_new string, publication_ref array<string>, {_ROW}",
    "obs_alterations_deletions": f"id int, obsid string, publication_ref array<string>, status int, {_ROW}",
    "obs_alterations_redesignations": (
        "id int, " + _strings(
            "obsid packed_provisional_designation_from unpacked_provisional_designation_from "
            "packed_provisional_designation_to unpacked_provisional_designation_to")
        + f", publication_ref array<string>, status int, new_designation_created boolean, {_ROW}"),
    "obs_alterations_unassociations": (
        "id int, " + _strings("obsid unpacked_provisional_designation_from "
                              "packed_provisional_designation_from trkmpc_to")
        + f", publication_ref array<string>, {_ROW}"),
    "obs_sbn": (
        "id int, healpix bigint, ctr int, nucmag smallint, com smallint, prectime int, nstars int, "
        "obstime timestamp_ntz, designation_asterisk boolean, shapeocc boolean, all_pub_ref array<string>, "
        + _strings("trksub trkid obsid submission_id submission_block_id obs80 status ref permid provid "
                   "artsat mode stn trx rcv sys prog obscenter astcat band photcat disc subfrm subfmt "
                   "notes remarks deprecated localuse prev_desig prev_ref trkmpc orbit_id obssubid "
                   "replacesobsid group_id fltr obstime_text") + ", "
        + _doubles("pos1 pos2 pos3 poscov11 poscov12 poscov13 poscov22 poscov23 poscov33 ra dec rastar "
                   "decstar deltara deltadec dist pa rmsra rmsdec rmsdist rmspa rmscorr delay rmsdelay "
                   "doppler rmsdoppler mag rmsmag photap logsnr seeing exp rmsfit frq precra precdec "
                   "unctime rmstime vel1 vel2 vel3") + f", {_ROW}"),
    "obscodes": (
        "id int, " + _strings("obscode name firstdate lastdate web_link short_name name_utf8 name_latex "
                              "observations_type") + ", " + _doubles("longitude rhocosphi rhosinphi")
        + f", uses_two_line_observations boolean, old_names array<string>, {_ROW}"),
    "primary_objects": (
        f"id int, {_DES}, status int, orbit_published int, object_type int, "
        "orbit_publication_references array<string>, " + ", ".join(f"{c} boolean" for c in (
            "standard_minor_planet standard_epoch orbfit_epoch nongravs satellite comet barycentric "
            "no_orbit flag_all_object_obs_consistent flag_orbit_calculated_from_consistent_obs "
            "flag_allowed_external").split()) + f", {_ROW}"),
    # Tables this package maintains.
    "source_membership": (
        "source string, primary_desig string, packed_desig string, permid string, raw_string string, "
        "desig_parsed boolean, orbit_in_mpc boolean, is_comet boolean, first_seen timestamp_ntz, "
        "last_seen timestamp_ntz, last_refreshed timestamp_ntz, nf_q float, nf_neo_prob float, nf_u float"),
    "source_runs": (
        "source string, started_at timestamp_ntz, finished_at timestamp_ntz, status string, "
        "n_rows int, n_unresolved int, error_text string"),
}
