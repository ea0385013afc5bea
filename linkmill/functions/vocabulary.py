"""Word lists and aliases that decide what names, streets and columns mean."""

from __future__ import annotations

LEGAL_FORMS = (
    "sa sas sasu sarl srl sprl scrl sc snc sca sep se soc societe association asbl aisbl fondation foundation stichting vzw ivzw "
    "nv bv bvba cv cvba vof commv commanditaire gcv maatschap cooperatieve vennootschap naamloze besloten limited ltd llc inc plc company corp corporation"
).split()

DOTTED_LEGAL_FORMS = "aisbl asbl bv bvba commv cv cvba gcv inc ivzw llc ltd nv plc sa sca sc scrl snc sprl srl vof vzw".split()

NAME_CONNECTORS = "a au aux d de den der des du een en et het la le les l of the van voor".split()

# Too common to narrow a search; they stay in names.
GENERIC_NAME_WORDS = (
    "belge belgique belgie belgium bruxelles brussel centre consult consulting enterprise entreprise group groupe holding international services solutions"
).split()

# Tokens are accent-free when compared, so the accented spellings never meet one ("dreve" stays).
STREET_TYPES = (
    "allee allée avenue baan berg boulevard chaussee chaussée chemin clos dreef drève galerie grandplace grote kaai laan lei markt parc place plein "
    "quai route rue sentier square steenweg straat voie weg"
).split()

STREET_CONNECTORS = "a aan au aux d de den der des du het la le les l op van".split()

STREET_TYPE_SUFFIXES = "steenweg straat dreef plein laan baan kaai lei weg".split()

NULL_TEXTS = "nan none null nat".split()

BOX_WORDS = "box boite bte bus unit appartement apt".split()

CONTACT_ALIASES = {
    "source_id": "reference reference_id contact_reference contact_id id_contact id identifiant".split(),
    "enterprise_number": "numero_entreprise numero_dentreprise n_entreprise n_dentreprise enterprise_number enterprisenumber company_number vat_number tva numero_tva bce kbo".split(),
    "company_name": "nom_entreprise nom_de_lentreprise company_name company organisation organization raison_sociale societe société denomination dénomination legal_name business_name name".split(),
    "street": "street3 street_name street rue adresse_rue address_street voie".split(),
    "house_number": "street_number house_number housenumber numero_rue numero numéro number no nr".split(),
    "box": "street_box box_number box boite boîte bte bus unit".split(),
    "postcode": "zip zipcode zip_code postcode postal_code code_postal cp".split(),
    "city": "city city_name ville commune municipality locality".split(),
    "full_address": "adresse address full_address adresse_complete adresse_complète complete_address".split(),
}

REFERENCE_ALIASES = {
    "enterprise_number": "numero_entreprise enterprise_number enterprisenumber company_number bce kbo".split(),
    "company_name": "nom_entreprise company_name denomination name".split(),
    "street": "street_name street3 street rue".split(),
    "house_number": "house_number street_number housenumber numero".split(),
    "box": "box_number street_box box boite bte bus".split(),
    "postcode": "postcode zip zipcode postal_code code_postal".split(),
    "city": "city_name city ville municipality".split(),
    "status": "status statut".split(),
}
