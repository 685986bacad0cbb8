"""The six register datasets and their static metadata."""

from __future__ import annotations

from ledgerline.spec import DatasetSpec, columns

# Names, types, keys and volatile columns of the six datasets.
SOURCE = "no_sodir"

FIELD_PRODUCTION_MONTHLY = DatasetSpec(
    source=SOURCE,
    table="field_production_monthly",
    keys=("prfNpdidInformationCarrier", "prfYear", "prfMonth"),
    columns=columns("""
        prfNpdidInformationCarrier bigint
        prfYear int
        prfMonth int
        prfInformationCarrier string
        prfPrdOilNetMillSm3 double
        prfPrdGasNetBillSm3 double
        prfPrdNGLNetMillSm3 double
        prfPrdCondensateNetMillSm3 double
        prfPrdOeNetMillSm3 double
        prfPrdProducedWaterInFieldMillSm3 double
    """),
)

FIELD = DatasetSpec(
    source=SOURCE,
    table="field",
    keys=("fldNpdidField",),
    volatile=("fldDateUpdatedMax", "DatesyncNPD"),
    columns=columns("""
        fldNpdidField bigint
        fldName string
        cmpLongName string
        fldCurrentActivitySatus string
        wlbName string
        wlbCompletionDate date date
        fldMainArea string
        fldOwnerKind string
        fldOwnerName string
        fldMainSupplyBase string
        fldHcType string
        fldNpdidOwner bigint
        wlbNpdidWellbore bigint
        cmpNpdidCompany bigint
        fldFactPageUrl string
        fldFactMapUrl string
        fldDateUpdated date date
        fldDateUpdatedMax date date
        DatesyncNPD date date
    """),
)

COMPANY = DatasetSpec(
    source=SOURCE,
    table="company",
    keys=("cmpNpdidCompany",),
    volatile=("dateSyncNPD",),
    columns=columns("""
        cmpNpdidCompany bigint
        cmpLongName string
        cmpOrgNumberBrReg string blank
        cmpShortName string
        cmpNationCode string
        cmpSurveyPrefix string
        cmpLicenceOperCurrent boolean flag
        cmpLicenceOperFormer boolean flag
        cmpLicenceLicenseeCurrent boolean flag
        cmpLicenceLicenseeFormer boolean flag
        cmpTufOperCurrent boolean flag
        cmpTufOperFormer boolean flag
        cmpTufPartnerCurrent boolean flag
        cmpTufPartnerFormer boolean flag
        cmpBsnsArrAreaOperCurrent boolean flag
        cmpBsnsArrAreaOperFormer boolean flag
        cmpBsnsArrAreaPartnerCurrent boolean flag
        cmpBsnsArrAreaPartnerFormer boolean flag
        dateSyncNPD date date
    """),
)

COMPANY_RESERVES = DatasetSpec(
    source=SOURCE,
    table="company_reserves",
    keys=("fldNpdidField", "cmpNpdidCompany"),
    volatile=("DatesyncNPD",),
    columns=columns("""
        fldNpdidField bigint
        cmpNpdidCompany bigint
        cmpLongName string
        fldName string
        cmpRemainingOil double
        cmpRemainingGas double
        cmpRemainingNGL double
        cmpRemainingCondensate double
        cmpRemainingOE double
        cmpDateOffResEstDisplay date date
        cmpShare double
        DatesyncNPD date date
    """),
)

FIELD_DESCRIPTION = DatasetSpec(
    source=SOURCE,
    table="field_description",
    keys=("fldNpdidField", "fldDescriptionHeading"),
    volatile=("DatesyncNPD",),
    multiline=True,
    columns=columns("""
        fldNpdidField bigint
        fldDescriptionHeading string
        fldName string
        fldDescriptionText string
        fldDescriptionDateUpdated date date
        DatesyncNPD date date
    """),
)

FIELD_OPERATOR_HST = DatasetSpec(
    source=SOURCE,
    table="field_operator_hst",
    keys=("fldNpdidField", "cmpNpdidCompany", "fldOperatorFrom"),
    volatile=("fldOperatorDateUpdated", "datesyncNPD"),
    key_labels=("fldName", "cmpLongName"),
    columns=columns("""
        fldNpdidField bigint
        cmpNpdidCompany bigint
        fldOperatorFrom date date
        fldName string
        cmpLongName string
        fldOperatorTo date date
        fldOperatorDateUpdated date date
        datesyncNPD date date
    """),
)

DATASETS = {
    spec.code: spec
    for spec in (
        FIELD_PRODUCTION_MONTHLY,
        FIELD,
        COMPANY,
        COMPANY_RESERVES,
        FIELD_DESCRIPTION,
        FIELD_OPERATOR_HST,
    )
}

# The static metadata files, as CSV text.

SOURCES_CSV = """\
id,code,name,scope,url
1,jodi_oil,JODI Oil,Public,https://www.jodidata.org/oil/database/data-downloads.aspx
2,jodi_gas,JODI Gas,Public,https://www.jodidata.org/gas/database/data-downloads.aspx
3,eia,EIA International,Public,https://api.eia.gov/v2/international/
4,iea,IEA Monthly Oil Statistics,Private,https://www.iea.org/data-and-statistics/data-product/monthly-oil-statistics
5,opec_momr,OPEC Monthly Oil Market Report,Public,https://www.opec.org/opec_web/en/publications/338.htm
6,opec_asb,OPEC Annual Statistical Bulletin,Public,https://www.opec.org/opec_web/en/data_graphs/330.htm
7,energy_institute,Energy Institute Statistical Review,Public,https://www.energyinst.org/statistical-review
8,no_sodir,Norwegian Offshore Directorate (Sodir),Public,https://www.sodir.no
9,nsta,UK NSTA,Public,https://www.nstauthority.co.uk/data-and-insights/data/themes/production/
10,anp,Brazil ANP,Public,https://www.gov.br/anp/pt-br/assuntos/producao-e-royalties/producao
11,cer,Canada CER,Public,https://www.cer-rec.gc.ca/en/data-analysis/energy-commodities/crude-oil-petroleum-products/statistics/
12,cnh,Mexico CNH,Public,https://hidrocarburos.gob.mx/estadisticas-de-produccion/
13,anh,Colombia ANH,Public,https://www.anh.gov.co/es/administracion-del-recurso/gestion-del-recurso-hidrocarburifero/estadisticas-hidrocarburos
14,argentina_se,Argentina Secretaría de Energía,Public,https://www.argentina.gob.ar/economia/energia/hidrocarburos/produccion
15,nlog,Netherlands NLOG,Public,https://www.nlog.nl/en/production-data
"""

DATASETS_CSV = """\
id,code,name,source_id,copyright,type,format,parent_code,granularity,periodicity,keys,url
1,no_sodir_field_production_monthly,Sodir field production (monthly),8,No,FILE,CSV,,field,monthly,"prfNpdidInformationCarrier, prfYear, prfMonth",https://factpages.sodir.no/en/field/TableView/Production/Saleable/Monthly
2,no_sodir_field,Sodir fields,8,No,FILE,CSV,,field,snapshot,fldNpdidField,https://factpages.sodir.no/en/field/TableView/Overview
3,no_sodir_company,Sodir companies,8,No,FILE,CSV,,company,snapshot,cmpNpdidCompany,https://factpages.sodir.no/en/company/TableView/All
4,no_sodir_company_reserves,Sodir company reserves,8,No,FILE,CSV,,field,snapshot,"fldNpdidField, cmpNpdidCompany",https://factpages.sodir.no/en/company/TableView/Reserves
5,no_sodir_field_description,Sodir field descriptions,8,No,FILE,CSV,,field,snapshot,"fldNpdidField, fldDescriptionHeading",https://factpages.sodir.no/en/field/TableView/Description
6,no_sodir_field_operator_hst,Sodir field operators,8,No,FILE,CSV,,field,snapshot,"fldNpdidField, cmpNpdidCompany, fldOperatorFrom",https://factpages.sodir.no/en/field/TableView/Operators
"""

BUSINESS_DOMAINS_CSV = """\
id,code,name,description
1,sup,Supply,"Indicators of hydrocarbon supply: production, reserves and where they come from"
"""

BUSINESS_CONCEPTS_CSV = """\
id,code,name,description,business_domain_id
1,field,Field,Geographical area of provenance of a product,1
2,cmp,Company,Companies exploring hydrocarbon fields,1
"""

HOOKS_CSV = """\
id,business_concept_id,dataset_id,hook_expression_dev,hook_expression_prod,hook_encoding,hook_role
1,1,1,prfInformationCarrier,prfNpdidInformationCarrier,integer,
2,1,2,fldName,fldNpdidField,integer,
3,2,2,cmpLongName,cmpNpdidCompany,integer,Operator
4,2,3,cmpLongName,cmpNpdidCompany,integer,
5,2,4,cmpLongName,cmpNpdidCompany,integer,
6,1,4,fldName,fldNpdidField,integer,
7,1,5,fldName,fldNpdidField,integer,
8,1,6,fldName,fldNpdidField,integer,
9,2,6,cmpLongName,cmpNpdidCompany,integer,Operator
"""

STATIC = {
    "sources": SOURCES_CSV,
    "datasets": DATASETS_CSV,
    "business_domains": BUSINESS_DOMAINS_CSV,
    "business_concepts": BUSINESS_CONCEPTS_CSV,
    "hooks": HOOKS_CSV,
}
