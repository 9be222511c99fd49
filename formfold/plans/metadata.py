"""The metadata uuids that select record rows, by what they mean."""

# encounter types, in the order of the forms
ENCOUNTER_TYPES = {
    "contact": "ea68aad6-4655-4dc5-80f2-780e33055a9e",
    "client_enrollment": "c7f47a56-207b-11e9-ab14-d663bd873d93",
    "clinical_visit": "92e03f22-9686-11e9-bc42-526af7764f64",
    "sti_treatment": "2cc8c535-bbfa-4668-98c7-b12e3550ee7b",
    "peer_calendar": "c4f9db39-2c18-49a6-bf9b-b243d673c64d",
    "violence_screening": "7b69daf5-b567-4384-9d29-f020c408d613",
}

# forms of the HIV test table
TEST_FORMS = {
    "initial": "402dc5d7-46da-42d4-b2be-f43ea4ad87b0",
    "confirmatory": "b08471f6-0892-4bf7-ab2b-bf79797b8ea4",
}

# person attributes of the client registry
ATTRIBUTE_TYPES = {
    "alias_name": "aec1b592-1d8a-11e9-ab14-d663bd873d93",
    "phone_number": "b2c38640-2603-4629-aebd-3b54f33f1e3a",
    "alt_phone_number": "94614350-84c8-41e0-ac29-86bc107069be",
    "email_address": "b8d0b331-1d2d-4a9a-b741-1816f498bdb6",
}

# identifiers of the client registry, and the one shown on contacts
IDENTIFIER_TYPES = {
    "national_id_number": "49af6cdc-7968-4abb-bf46-de10d7f4859f",
    "passport_number": "aec1b20e-1d8a-11e9-ab14-d663bd873d93",
}
CONTACT_IDENTIFIER = "b7bfefd0-239b-11e9-ab14-d663bd873d93"

# address columns of the registry and the address fields they come from
ADDRESS_FIELDS = {
    "postal_address": "address1",
    "county": "county_district",
    "sub_county": "state_province",
    "location": "address6",
    "sub_location": "address5",
    "village": "city_village",
}

# (concept, code) pairs that let the derived test forms meet every kit rule
KIT_CONCEPTS_SAMPLE = [
    (162084, 162082), (162084, 162080),
    (1040, 703), (1040, 664), (1040, 163611),
    (1326, 703), (1326, 664), (1326, 1175),
    (164962, 164960), (164962, 164961),
    (164964, None), (162502, None),
]
