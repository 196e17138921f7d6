"""Synthetic inpatient documents for the extraction tests (invented values)."""

NS = 'xmlns="urn:hl7-org:v3"'


def inpatient(*, ids=('<id root="2.1" extension="RN32_101"/>',),
              titles=("<title>Inpatient</title>",),
              patient_id="ID4401", age="37", addrs=("<addr><city>C1</city><county>K1</county></addr>",),
              low='<low value="20240312080000"/>',
              doctors=("DR2555", "DR1777"), dept="KS07",
              diagnoses=('<name displayName="JB042"/>', '<name displayName="ZD9"/>'),
              tail="", prefix="", root_open=None):
    auth = "".join(f'<authenticator><assignedEntity><id extension="{d}"/></assignedEntity>'
                   f'</authenticator>' for d in doctors)
    entries = "".join(f"<entry><observation><code><qualifier>{n}</qualifier></code>"
                      f"</observation></entry>" for n in diagnoses)
    head = root_open or f"<ClinicalDocument {NS}>"
    return (prefix + head + '<realmCode code="CN"/>' + "".join(ids)
            + '<code code="C0032"/>' + "".join(titles)
            + '<effectiveTime value="20240315101010"/><languageCode code="zh-CN"/>'
            + "<recordTarget><patientRole>" + "".join(addrs)
            + f'<patient><id extension="{patient_id}"/><administrativeGenderCode code="2"/>'
            + f'<age value="{age}"/></patient></patientRole></recordTarget>'
            + '<legalAuthenticator><assignedEntity><id extension="XX2000"/></assignedEntity>'
            + "</legalAuthenticator>" + auth
            + f"<componentOf><encompassingEncounter><effectiveTime>{low}</effectiveTime>"
            + "<location><healthCareFacility><serviceProviderOrganization>"
            + '<asOrganizationPartOf><wholeOrganization><id extension="W1"/>'
            + f'<asOrganizationPartOf><wholeOrganization><id extension="{dept}"/>'
            + "</wholeOrganization></asOrganizationPartOf></wholeOrganization>"
            + "</asOrganizationPartOf></serviceProviderOrganization></healthCareFacility>"
            + "</location></encompassingEncounter></componentOf>"
            + "<component><structuredBody><component><section>" + entries
            + "</section></component></structuredBody></component>"
            + "</ClinicalDocument>" + tail)
