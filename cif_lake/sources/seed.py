"""Seed dictionary: the categories the analyses of this library read.

The full dictionaries are not shipped; compile them with ``cif_lake.sources.dictionary``.
Fixed values: category and item names, their types (d = double, i = bigint, no mark = text), keys, links and the
addresses of the public dictionaries.
"""

BASE_URL = "https://mmcif.wwpdb.org/dictionaries/mmcif_pdbx_v50.dic"

# category: (is_single_row, items)
CATEGORIES = {
    "atom_site": (
        False,
        "group_PDB id type_symbol label_atom_id label_alt_id label_comp_id label_asym_id label_entity_id label_seq_id:i "
        "pdbx_PDB_ins_code Cartn_x:d Cartn_y:d Cartn_z:d occupancy:d B_iso_or_equiv:d pdbx_formal_charge:i auth_seq_id "
        "auth_comp_id auth_asym_id auth_atom_id pdbx_PDB_model_num:i",
    ),
    "cell": (True, "entry_id length_a:d length_b:d length_c:d"),
    "chem_comp": (False, "id type name formula formula_weight:d pdbx_formal_charge:i"),
    "chem_comp_atom": (False, "comp_id atom_id type_symbol model_Cartn_x:d model_Cartn_y:d model_Cartn_z:d pdbx_ordinal:i"),
    "chem_comp_bond": (False, "comp_id atom_id_1 atom_id_2 value_order pdbx_ordinal:i"),
    "em_3d_reconstruction": (None, "id resolution:d num_particles:i"),
    "em_image_scans": (None, "id frames_per_image:i used_frames_per_image"),
    "entity": (False, "id type"),
    "entity_poly": (False, "entity_id type pdbx_strand_id"),
    "entity_poly_seq": (False, "entity_id num:i mon_id"),
    "entry": (True, "id"),
    "exptl": (False, "entry_id method"),
    "ma_model_list": (False, "ordinal_id:i model_id:i model_name"),
    "ma_qa_metric": (False, "id:i mode name type"),
    "ma_qa_metric_global": (False, "ordinal_id:i model_id:i metric_id:i metric_value:d"),
    "ma_qa_metric_local": (False, "ordinal_id:i model_id:i label_asym_id label_seq_id:i label_comp_id metric_id:i metric_value:d"),
    "pdbx_database_status": (True, "entry_id status_code recvd_initial_deposition_date"),
    "pdbx_nonpoly_scheme": (False, "asym_id entity_id mon_id pdb_strand_id"),
    "pdbx_poly_seq_scheme": (False, "asym_id entity_id seq_id:i mon_id pdb_strand_id"),
    "pdbx_struct_assembly": (False, "id details"),
    "pdbx_struct_assembly_gen": (False, "assembly_id oper_expression asym_id_list"),
    "pdbx_struct_assembly_prop": (False, "biol_id type value"),
    "pdbx_struct_oper_list": (False, "id type"),
    "refine": (False, "entry_id pdbx_refine_id ls_d_res_high:d ls_d_res_low:d"),
    "software": (False, "pdbx_ordinal:i name version classification"),
    "struct": (True, "entry_id title"),
    "struct_asym": (False, "id entity_id details"),
    "struct_conf": (
        False,
        "conf_type_id id beg_label_asym_id beg_label_comp_id beg_label_seq_id:i end_label_asym_id end_label_comp_id "
        "end_label_seq_id:i beg_auth_asym_id end_auth_asym_id",
    ),
    "struct_conf_type": (False, "id"),
    "struct_ref": (False, "id entity_id db_name db_code pdbx_db_accession pdbx_db_isoform"),
    "struct_ref_seq": (False, "align_id ref_id pdbx_strand_id pdbx_db_accession db_align_beg:i db_align_end:i"),
    "struct_ref_seq_dif": (False, "align_id pdbx_pdb_strand_id mon_id"),
    "struct_sheet": (False, "id type"),
    "struct_sheet_range": (
        False,
        "sheet_id id beg_label_asym_id beg_label_seq_id:i end_label_asym_id end_label_seq_id:i beg_auth_asym_id end_auth_asym_id",
    ),
}

# (parent, child)
LINKS = [
    ("_atom_site.auth_asym_id", "_struct_conf.beg_auth_asym_id"),
    ("_atom_site.auth_asym_id", "_struct_conf.end_auth_asym_id"),
    ("_atom_site.auth_asym_id", "_struct_sheet_range.beg_auth_asym_id"),
    ("_atom_site.auth_asym_id", "_struct_sheet_range.end_auth_asym_id"),
    ("_atom_site.label_asym_id", "_struct_conf.beg_label_asym_id"),
    ("_chem_comp.id", "_chem_comp_atom.comp_id"),
    ("_chem_comp.id", "_chem_comp_bond.comp_id"),
    ("_chem_comp_atom.atom_id", "_chem_comp_bond.atom_id_1"),
    ("_chem_comp_atom.atom_id", "_chem_comp_bond.atom_id_2"),
    ("_chem_comp_atom.comp_id", "_chem_comp_bond.comp_id"),
    ("_entity.id", "_entity_poly.entity_id"),
    ("_entity.id", "_struct_asym.entity_id"),
    ("_entity.id", "_struct_ref.entity_id"),
    ("_entry.id", "_exptl.entry_id"),
    ("_entry.id", "_pdbx_database_status.entry_id"),
    ("_entry.id", "_refine.entry_id"),
    ("_entry.id", "_struct.entry_id"),
    ("_struct_asym.id", "_atom_site.label_asym_id"),
    ("_struct_asym.id", "_pdbx_poly_seq_scheme.asym_id"),
    ("_struct_ref.id", "_struct_ref_seq.ref_id"),
]

# Mandatory categories and the groups of some, as far as the analyses show them.
MANDATORY = {"entry": True, "cell": False, "atom_site": False, "refine": False}
GROUPS = {"cell": ["cell_group", "inclusive_group"], "atom_site": ["atom_group", "inclusive_group"], "entry": ["entry_group", "inclusive_group"]}
